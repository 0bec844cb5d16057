"""Connected components by local union-find and alternating star contraction, on any orderable node type."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, discard, table

#: Edges that a task joins at once; a graph of more is contracted in several tasks, and then between them.
BLOCK = 250_000


def stars(edges: list[tuple]) -> list[tuple]:
    """(node, least node of its component) for all nodes of some edges but the least ones."""
    root: dict = {}

    def find(x):
        top = root.setdefault(x, x)
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in list(root) if root[x] != x]


def contracted(edges: DataFrame, parts: int, block: int) -> DataFrame:
    """The edges in so many tasks, each block of them as stars: connected as before, and never more edges."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(edges.schema)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if len(held) >= block:
                yield from given(stars(held))
                held = []
        yield from given(stars(held))

    def given(found: list[tuple]):
        for start in range(0, len(found), 10_000):
            part = found[start : start + 10_000]
            yield {"a": [a for a, _ in part], "b": [b for _, b in part]}

    return edges.coalesce(parts).mapInArrow(arrow_rows(run, pa.schema(list(schema))), edges.schema)


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node's larger (or not larger) neighbours are linked to its least one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable from each node that has an edge. Edges are (a, b).

    Edges are contracted to stars in tasks of about BLOCK edges. If one task held them all, these are the components; else
    rounds of star contraction follow, which halve what is left between a node and its root at least. Each round ends as a
    written table; a hub's edges are spread by pre-aggregation and skew joins, not gathered.
    """
    edges = table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", clean=False)
    count = edges.count()
    parts = max(1, math.ceil(count / BLOCK))
    # A last block that is not full comes last, so one part of at most BLOCK edges is one block.
    local = table(contracted(edges, parts, BLOCK + 1).distinct(), "edges", clean=False)
    discard(edges)
    edges, before = local, None
    while parts > 1:
        mark = tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
        further = table(star(star(edges, True), False), "edges", clean=False)
        discard(edges)
        edges = further
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
