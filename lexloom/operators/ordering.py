"""Order-dependent logic as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def carry_forward(df: DataFrame, value: Column, group: str, order: str, name: str) -> DataFrame:
    """The last value at or before each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(group).orderBy(order)))


def islands(df: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """Runs of rows with the same value: group, island number from 1, value, first and last position, size."""
    w = Window.partitionBy(group).orderBy(order)
    begins = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    numbered = df.withColumn("__begin", begins).withColumn("island", F.sum("__begin").over(w))
    return numbered.groupBy(group, "island", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("size"))


def overlaps(df: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    """Ranges that begin before the end of the range before them."""
    w = Window.partitionBy(*group).orderBy(start, end)
    return df.withColumn("previous_end", F.lag(end).over(w)).where(F.col(start) < F.col("previous_end"))


def split_runs(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keys whose rows don't stand together; order counts rows without gaps. An aggregate, so no task holds all rows."""
    runs = df.groupBy(key).agg(F.count("*").alias("n"), (F.max(order) - F.min(order) + 1).alias("reach"))
    return runs.where("n < reach").select(key)


def line_numbers(lines: DataFrame, place: str, order: str) -> DataFrame:
    """(place, line): lines numbered from 1. Only one count a partition is ordered in one task."""
    part = F.shiftright(place, 33)
    sizes = lines.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
    before = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = lines.withColumn("__part", part).join(starts, "__part")
    return numbered.select(F.col(place).alias("place"), (F.col("__start") + F.col(place).bitwiseAND((1 << 33) - 1) + 1).alias("line"))
