"""Alignment decisions as rows: one for each link, or one blank row for an abstention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("alignment_id", "source_id", "target_id", "relation", "reason")


def to_rows(decisions: DataFrame) -> DataFrame:
    """(alignment_id, source_id, links) to TSV rows."""
    return decisions.select("alignment_id", "source_id", F.explode_outer("links").alias("l")).select(
        "alignment_id", "source_id", *[F.coalesce(F.col(f"l.{c}"), F.lit("")).alias(c) for c in FIELDS[2:]]
    )


def from_rows(rows: DataFrame) -> DataFrame:
    """TSV rows back to decisions, links by target; a blank row is an empty array."""
    link = F.when(F.col("target_id") != "", F.struct("target_id", "relation", "reason"))
    return rows.groupBy("alignment_id", "source_id").agg(F.array_sort(F.collect_list(link)).alias("links"))


def repeated_targets(links: DataFrame, query: str, source: str, target: str) -> DataFrame:
    """Violations of one-to-one: sources with two targets, or targets with two sources, within a query."""
    by_source = links.groupBy(query, F.col(source).alias("id")).agg(F.count_distinct(target).alias("n")).where("n > 1").withColumn("side", F.lit("source"))
    by_target = links.groupBy(query, F.col(target).alias("id")).agg(F.count_distinct(source).alias("n")).where("n > 1").withColumn("side", F.lit("target"))
    return by_source.unionByName(by_target)


def statistics(results: DataFrame, task: str, links: str) -> DataFrame:
    """Per task: evaluated, aligned and unaligned sources, and associations."""
    size = F.size(links)
    return results.groupBy(task).agg(
        F.count("*").alias("evaluated"), F.sum((size > 0).cast("long")).alias("aligned"),
        F.sum((size == 0).cast("long")).alias("unaligned"), F.sum(size.cast("long")).alias("associations"),
    )
