"""Joins of the three dataflows. Equi-joins throughout: the planner broadcasts a side only below its size threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def look_up(left: DataFrame, right: DataFrame, on: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Left join to at most one row, with defaults where there is none."""
    return left.join(right, on, "left").withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def fill_label(rows: DataFrame, labels: DataFrame, on: str, column: str) -> DataFrame:
    """Fill empty labels from a table of first-seen ones."""
    known = labels.select(on, F.col(column).alias("__known"))
    return rows.join(known, on, "left").withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), "__known")).drop("__known")


def without(rows: DataFrame, known: DataFrame, on: list[str], exempt: Column | None = None) -> DataFrame:
    """Rows whose key isn't known; exempt rows pass."""
    if exempt is None:
        return rows.join(known.select(*on).distinct(), on, "left_anti")
    flagged = rows.join(known.select(*on).distinct().withColumn("__known", F.lit(True)), on, "left")
    return flagged.where(F.col("__known").isNull() | exempt).drop("__known")


def block(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str) -> DataFrame:
    """Candidate pairs of a record-linkage step: rows that share a key, each pair once."""
    return left.select(left_id, *on).distinct().join(right.select(right_id, *on).distinct(), on).select(left_id, right_id).distinct()


def unique_fallback(direct: DataFrame, fallback: DataFrame, key: str, value: str) -> DataFrame:
    """Direct matches, and for keys without one the fallback if it names exactly one value."""
    single = fallback.groupBy(key).agg(F.count_distinct(value).alias("n"), F.min(value).alias(value)).where("n = 1").drop("n")
    second = single.join(direct.select(key).distinct(), key, "left_anti")
    return direct.select(key, value, F.lit("direct").alias("via")).unionByName(second.select(key, value, F.lit("fallback").alias("via")))


def best_without_ties(scored: DataFrame, key: str, value: str, score: str, least: float) -> DataFrame:
    """The best value of each key if its score is high enough and no other value ties."""
    order = Window.partitionBy(key).orderBy(F.desc(score), value)
    ranked = scored.select(key, value, score).withColumns({"__rank": F.row_number().over(order), "__next": F.lead(score).over(order)})
    return ranked.where((F.col("__rank") == 1) & (F.col(score) >= least) & (F.col("__next").isNull() | (F.col("__next") < F.col(score)))).drop("__rank", "__next")


def resolve_pointers(pointers: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables that pointers (entry_id, gloss, target_id, gloss_key) name, under the pointer's own entry and gloss."""
    own = tables.select(F.col("entry_id").alias("target_id"), "gloss_key", *[c for c in tables.columns if c not in ("entry_id", "gloss_key", "gloss")])
    return pointers.join(own, ["target_id", "gloss_key"])


def exclude_stages(candidates: DataFrame, sources: str, earlier: list[str]) -> DataFrame:
    """Candidates without evidence from an earlier stage; sources is an array column."""
    if not earlier:
        return candidates
    return candidates.where(~F.arrays_overlap(F.col(sources), F.array(*map(F.lit, earlier))))


def pending(queries: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """What the cache doesn't decide yet."""
    return queries.join(cache.select(key).distinct(), key, "left_anti")


def apply_links(rows: DataFrame, links: DataFrame, key: str, target: str, kind: str = "string") -> DataFrame:
    """Rows with the sorted array of their linked targets; empty if none."""
    grouped = links.groupBy(key).agg(F.sort_array(F.collect_set(target)).cast(f"array<{kind}>").alias("targets"))
    return look_up(rows, grouped, [key], {"targets": F.array().cast(f"array<{kind}>")})
