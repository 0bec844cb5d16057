"""Approximate nearest neighbours by adaptive dimension scans in an inverted file.

Vectors are scaled to length 1, rotated by a fixed random orthogonal matrix and dealt to lists by the nearest of
`n_lists` centroids. A query visits its nearest lists. Within a list the rotated candidates lie in blocks of columns:
after each block the partial squared distance, scaled up to all dimensions, is tested against the distance of the k-th
best so far, and a candidate goes as soon as the hypothesis that it is nearer is rejected. Survivors are scored in double
precision on the original vectors.

Rotation, centroids and the number of lists to visit are fitted on SAMPLE distinct vectors at most (least hash first);
every vector is indexed. The number of lists to visit is the least at which the sample's own neighbours are covered to
COVERAGE. A list of more than BLOCK vectors is dealt to several tasks. Equal vectors are indexed once with their least
ids, as many as a result can hold, and equal queries are answered once: copies cost nothing.

Defined cases: vectors that are null, zero, hold nulls or non-finite components, or have another dimension than most of
the sample take no part, nor do rows without id; equal rows count once; fewer candidates than asked for are all returned;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, table

SAMPLE = 20_000
MOST_LISTS = 4096
BLOCK = 4096
COVERAGE = 0.975
TEST_QUERIES = 400
#: Columns in a block, and how sure a test must be: the higher, the fewer candidates it drops wrongly.
COLUMNS, EPSILON = 16, 2.1


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    n_probe: int

    def prepare(self, vectors: np.ndarray) -> np.ndarray:
        """Scaled and rotated vectors."""
        wide = vectors.astype(np.float64)
        wide = wide / np.abs(wide).max(axis=1, keepdims=True)
        return ((wide / np.linalg.norm(wide, axis=1, keepdims=True)) @ self.rotation).astype(np.float32)

    def lists(self, rotated: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each vector, nearest first."""
        near = rotated @ self.centroids.T - 0.5 * (self.centroids**2).sum(axis=1)
        return np.argsort(-near, axis=1, kind="stable")[:, :n]


def rotation(dimension: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(11)).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(12))
    centroids = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = np.concatenate([(x[s : s + 4096] @ centroids.T - 0.5 * (centroids**2).sum(axis=1)).argmax(axis=1) for s in range(0, len(x), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        counts = np.bincount(at, minlength=k)[:, None]
        centroids = np.where(counts > 0, sums / np.maximum(counts, 1), x[random.choice(len(x), k)])
    return centroids.astype(np.float32)


def fit(sample: np.ndarray, n_vectors: int, k: int = 5, coverage: float = COVERAGE) -> Index:
    """Rotation, centroids and the number of lists to visit, from a sample of distinct vectors."""
    n_lists = int(min(max(round(np.sqrt(n_vectors)), 1), MOST_LISTS, max(len(sample) // 16, 1)))
    index = Index(rotation(sample.shape[1]), np.zeros((1, sample.shape[1]), np.float32), 1)
    x = index.prepare(sample)
    index.centroids = k_means(x, n_lists)
    own = index.lists(x, 1)[:, 0]
    chosen = np.linspace(0, len(x) - 1, min(TEST_QUERIES, len(x))).astype(int)
    near = x[chosen] @ x.T
    near[np.arange(len(chosen)), chosen] = -2
    best = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    if best.size:
        rank = np.argsort(index.lists(x[chosen], n_lists), axis=1)
        needed = np.sort(np.take_along_axis(rank, own[best], axis=1).ravel()) + 1
        index.n_probe = int(needed[min(int(np.ceil(coverage * len(needed))), len(needed)) - 1])
    return index


def scan(query: np.ndarray, candidates: np.ndarray, bound: float, k: int) -> tuple[np.ndarray, float]:
    """Places of the candidates that no test rejects, and the k-th least squared distance known now."""
    d = candidates.shape[1]
    alive = np.arange(len(candidates))
    partial = np.zeros(len(candidates))
    for start in range(0, d, COLUMNS):
        part = candidates[alive, start : start + COLUMNS] - query[start : start + COLUMNS]
        partial = partial + np.einsum("ij,ij->i", part, part)
        seen = min(start + COLUMNS, d)
        if seen < d and np.isfinite(bound):
            keep = partial * (d / seen) <= bound * (1 + EPSILON / np.sqrt(seen)) ** 2
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                return alive, bound
    if len(partial) >= k:
        bound = min(bound, float(np.partition(partial, k - 1)[k - 1]))
    keep = partial <= bound * (1 + 1e-5) + 1e-6
    return alive[keep], bound


def valid(col: Column) -> Column:
    finite = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return col.isNotNull() & (F.size(col) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(col, lambda x: x != 0)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    q, v = query.astype(np.float64), vectors.astype(np.float64)
    q, v = q / np.abs(q).max(), v / np.abs(v).max(axis=1, keepdims=True)
    return (v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of `vectors` for each row of `queries`, but rows with its own id."""
    schema_out = "query_id long, rank int, vec_id long, score double"
    shape = lambda df: (
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & valid(F.col("v"))).withColumn("vkey", F.md5(F.array_join(F.col("v").cast("array<string>"), ",")))
    )
    base, asked = shape(vectors), shape(queries)
    order = Window.partitionBy("vkey").orderBy("vec_id")
    distinct = (
        base.withColumn("at", F.dense_rank().over(order)).where(f"at <= {k + 1}")
        .groupBy("vkey").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.first("v").alias("v"))
    )
    distinct = table(distinct, "vectors")
    n_vectors = distinct.count()
    # SAMPLE vectors at most reach the driver.
    sample = [r.v for r in distinct.orderBy(F.xxhash64("vkey"), "vkey").limit(SAMPLE).select("v").collect()]
    if not sample:
        return vectors.sparkSession.createDataFrame([], schema_out)
    sizes = np.array([len(v) for v in sample])
    dimension = int(np.bincount(sizes).argmax())
    index = fit(np.array([v for v in sample if len(v) == dimension], np.float64), n_vectors, k)
    n_lists = len(index.centroids)
    schema = pa.schema([("list", pa.int32()), ("vkey", pa.string()), ("ids", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))])

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                at = index.lists(index.prepare(np.array(batch.column(2).to_pylist(), np.float64)), 1)[:, 0]
                yield {"list": at.tolist(), "vkey": batch.column(0), "ids": batch.column(1), "v": batch.column(2)}

    listed = distinct.where(F.size("v") == dimension).select("vkey", "ids", "v").mapInArrow(arrow_rows(assign, schema), "list int, vkey string, ids array<long>, v array<double>")
    listed = table(listed, "lists")
    # One number a list: MOST_LISTS at most.
    held = {r.list: r.n for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    parts = {place: -(-n // BLOCK) for place, n in held.items()}
    n_parts = F.element_at(F.array(*[F.lit(parts.get(i, 1)) for i in range(n_lists)]), F.col("list") + 1) if n_lists <= 64 else None
    if n_parts is None:
        counts = vectors.sparkSession.createDataFrame(sorted(parts.items()), "list int, n_parts int")
        dealt = listed.join(F.broadcast(counts), "list")  # MOST_LISTS rows at most
    else:
        dealt = listed.withColumn("n_parts", n_parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vkey"), F.col("n_parts")).cast("int"))
    visit_schema = pa.schema([("list", pa.int32()), ("part", pa.int32()), ("vkey", pa.string()), ("v", pa.list_(pa.float64()))])

    def visit(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).to_pylist()
            near = index.lists(index.prepare(np.array(rows, np.float64)), n_lists)
            out: dict[str, list] = {n: [] for n in visit_schema.names}
            for key, v, places in zip(batch.column(0).to_pylist(), rows, near.tolist(), strict=True):
                seen = 0
                for turn, place in enumerate(places):
                    # Where the lists are small, more of them are visited, until k others than the query itself are seen.
                    if turn >= index.n_probe and seen > k:
                        break
                    seen += held.get(place, 0)
                    for part in range(parts.get(place, 0)):
                        for column, value in zip(out.values(), (place, part, key, v), strict=True):
                            column.append(value)
                if len(out["list"]) > 20_000:
                    yield out
                    out = {n: [] for n in visit_schema.names}
            yield out

    distinct_queries = asked.where(F.size("v") == dimension).groupBy("vkey").agg(F.first("v").alias("v"))
    visits = distinct_queries.select("vkey", "v").mapInArrow(arrow_rows(visit, visit_schema), "list int, part int, vkey string, v array<double>")
    both = dealt.select("list", "part", F.lit(0).alias("kind"), "vkey", "ids", "v").unionByName(visits.withColumns({"kind": F.lit(1), "ids": F.lit(None).cast("array<long>")}))
    found_schema = pa.schema([("vkey", pa.string()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        now, ids, vectors_, rotated = None, [], [], None
        out: list[tuple] = []
        for batch in batches:
            for place, part, kind, key, own, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (place, part) != now:
                    now, ids, vectors_, rotated = (place, part), [], [], None
                if kind == 0:
                    ids.append(own)
                    vectors_.append(v)
                    continue
                if not ids:
                    continue
                if rotated is None:
                    plain = np.array(vectors_, np.float64)
                    rotated = index.prepare(plain)
                query = np.array(v, np.float64)
                turned = index.prepare(query[None])[0]
                first = min(len(ids), 16 * (k + 1))
                head, bound = scan(turned, rotated[:first], np.inf, k + 1)
                tail, bound = scan(turned, rotated[first:], bound, k + 1)
                places = np.concatenate([head, tail + first])
                scores = cosines(query, plain[places])
                best = sorted(zip((-scores).tolist(), [ids[p] for p in places.tolist()], strict=True))[: k + 1]
                out += [(key, own, -score) for score, own in best]
            if len(out) > 20_000:
                yield dict(zip(found_schema.names, map(list, zip(*out, strict=True)), strict=True))
                out = []
        if out:
            yield dict(zip(found_schema.names, map(list, zip(*out, strict=True)), strict=True))

    found = both.repartition("list", "part").sortWithinPartitions("list", "part", "kind", "vkey").mapInArrow(arrow_rows(answer, found_schema), "vkey string, ids array<long>, score double")
    best = Window.partitionBy("vkey").orderBy(F.desc("score"), "vec_id")
    top = found.select("vkey", F.explode("ids").alias("vec_id"), "score").withColumn("at", F.row_number().over(best)).where(f"at <= {k + 1}").drop("at")
    each = asked.select(F.col("vec_id").alias("query_id"), "vkey").distinct().join(top, "vkey").where("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(rank)).where(f"rank <= {k}").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
