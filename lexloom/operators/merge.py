"""Merging of split records: grouping by identifier with first-seen order, made explicit by an ordinal column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(value: Column, ordinal: Column) -> Column:
    """Values of a group by ordinal. collect_list alone has no order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(ordinal.alias("o"), value.alias("v")))), lambda x: x["v"])


def append_absent(lists: Column, kind: str = "string") -> Column:
    """Concatenate arrays, leaving out what stands in an earlier one; repeats within one array stay."""
    return F.aggregate(lists, F.array().cast(f"array<{kind}>"), lambda acc, x: F.concat(acc, F.filter(x, lambda y: ~F.array_contains(acc, y))))


def first_seen(rows: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """The first row of each key; partial results are one row a key and task, however many rows a key has."""
    rest = [F.col(c) for c in rows.columns if c not in key]
    found = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), ordinal).alias("first"))
    return found.select(*[c if c in key else F.col("first")[c].alias(c) for c in rows.columns])


def gather_variants(rows: DataFrame, target: str, variant: str, by: str | None = None) -> DataFrame:
    """The variants of each target, or of what it is called by; an entry is no variant of itself."""
    return rows.where(F.col(target) != F.col(variant)).groupBy(by or target).agg(F.sort_array(F.collect_set(variant)).alias("variants"))


def merge_tables(rows: DataFrame, key: list[str], word: str, label: str, ordinal: str) -> DataFrame:
    """Translation tables by entry, gloss and language: words as a set, the last non-empty label, and when first seen."""
    return rows.groupBy(*key).agg(
        F.min(ordinal).alias("first"),
        F.sort_array(F.collect_set(word)).alias("words"),
        F.max_by(F.nullif(F.col(label), F.lit("")), F.when(F.nullif(F.col(label), F.lit("")).isNotNull(), F.col(ordinal))).alias("label"),
    )


def known_keys(rows: DataFrame, entry: str, key: str, complete: Column) -> DataFrame:
    """For each entry the keys that are never incomplete."""
    grouped = rows.groupBy(entry).agg(F.collect_set(key).alias("all"), F.collect_set(F.when(~complete, F.col(key))).alias("open"))
    return grouped.select(entry, F.sort_array(F.array_except("all", "open")).alias("known"))
