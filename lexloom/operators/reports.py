"""Report aggregations: counts, histograms, shares, medians and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def histogram(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def median_of(counts: DataFrame, value: str, frequency: str) -> DataFrame:
    """The exact median of a table of frequencies."""
    return counts.agg(F.expr(f"percentile({value}, 0.5, {frequency})").alias("median"))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Counts of a key and their share of all rows; one pass, then a join with one row."""
    counts = count_by(df, key)
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select(key, "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def top_k(counts: DataFrame, k: int, n: str, tie: str) -> DataFrame:
    """The k most frequent, ties by what was seen first."""
    return counts.orderBy(F.desc(n), tie).limit(k)


def marginals(df: DataFrame, *keys: str) -> DataFrame:
    """All marginal counts of some keys in one pass."""
    return df.cube(*keys).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
