"""Removal of repeated byte strings by common-prefix interval trees over bucketed suffix arrays.

Every window of `length` bytes has one anchor: the least hashed k-gram in it, leftmost of equals. Equal windows have
equal anchors at equal places, so only suffixes that start at anchors with equal k-grams need to be sorted together:

1. Anchors of all texts are found, each with the range of windows it stands for and a hash of these windows' bytes (its
   context). Anchors whose k-gram is found once are dropped; equal contexts are counted before the shuffle.
2. A k-gram with one context repeats as a whole. For the others one text per distinct context is fetched.
3. In each such bucket the right contexts form an enhanced suffix array. A stack scan over its common prefixes yields the
   interval tree; in each interval a second scan, over what stands to the left, yields the groups with a common left
   extension. Groups that are diverse on both sides are the maximal repeats, with all their members; a window repeats if
   and only if it lies in one.
4. Buckets of more than HOT distinct contexts would not fit in a task: their windows are counted one by one, by a 128-bit
   hash, with partial aggregation. This splits a hot anchor exactly; the removed bytes are the same (tested).

No pairs of occurrences are ever made. Defined cases: a null or empty text, or one shorter than `length`, keeps all its
bytes; matches never cross texts; a null id stays null; equal rows repeat each other; other columns are kept by `prune`
and ignored elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, discard, small_batches, table, unused, utf8
from .hashing import PIECE, gram_hashes

LENGTH = 200
#: Bytes of an anchor's k-gram: a quarter of the length, so that anchors are far apart and rarely equal by chance.
K_SHARE = 4
HOT = 4096
PLACE = np.uint64((1 << 24) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each width values in a row, by prefix and suffix minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchors_of(data: bytes, length: int, k: int) -> Iterator[tuple[int, int, int, int]]:
    """(place, first window, last window, hash) of each anchor of a text."""
    array = np.frombuffer(data, np.uint8)
    for begin in range(0, len(data) - length + 1, PIECE):
        part = array[begin : begin + PIECE + length - 1]
        hashes = gram_hashes(part, k)
        least = sliding_least((hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), length - k + 1)
        place = (least & PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        at = place[first]
        yield from zip((at + begin).tolist(), (first + begin).tolist(), (last + begin).tolist(), hashes[at].view(np.int64).tolist(), strict=True)


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, kid (a hash of id and text) and text; a null id is joined as the least number."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return own.select("id", F.coalesce("id", F.lit(-(2**63))).alias("doc_id"), F.xxhash64("id", "text").alias("kid"), "text")


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("kid", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("h", pa.int64()), ("ctx", pa.int64())])

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc_id, kid, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = utf8(text)
                out += [(doc_id, kid, at, lo, hi, h, xxhash.xxh3_64_intdigest(data[lo : hi + length]) - 2**63) for at, lo, hi, h in anchors_of(data, length, k)]
                if len(out) > 100_000:
                    yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))
                    out = []
            if out:
                yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))

    return docs.select("doc_id", "kid", "text").mapInArrow(arrow_rows(run, schema), "doc_id long, kid long, at int, lo int, hi int, h long, ctx long")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of each interval of a suffix array, children before parents.

    prefixes[i] is the common prefix of the suffixes i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > shared:
            size, first = stack.pop()
            yield size, first, i
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


class Bucket:
    """The enhanced suffix array of one anchor's distinct contexts."""

    def __init__(self, lefts: list[bytes], rights: list[bytes]) -> None:
        self.lefts = [x[::-1] for x in lefts]
        self.rights = rights
        self.order = sorted(range(len(rights)), key=rights.__getitem__)
        self.prefixes = [common(rights[a], rights[b]) for a, b in zip(self.order, self.order[1:], strict=False)]

    def maximal(self, length: int) -> Iterator[tuple[int, int, list[int]]]:
        """Maximal repeats around the anchor: (bytes left of it, bytes right of it, all members), longest first by member.

        Members of an interval share what stands to their right and differ behind it. A second stack scan, over what
        stands to their left, gives the groups that also share a left extension and differ, or end, before it. A group
        is a maximal repeat if it is diverse on both sides, so one that lies within a single child interval goes: its
        members share more to the right and the child has reported them.
        """
        inner: dict[int, int] = {}  # each suffix's number of the last interval that held it
        for number, (size, first, last) in enumerate(intervals(self.prefixes)):
            members = sorted(self.order[first : last + 1], key=self.lefts.__getitem__)
            shared = [common(self.lefts[a], self.lefts[b]) for a, b in zip(members, members[1:], strict=False)]
            for extension, low, high in intervals(shared):
                if size + extension >= length:
                    group = members[low : high + 1]
                    child = inner.get(group[0])
                    if child is None or any(inner.get(m) != child for m in group):
                        yield extension, size, group
            for m in members:
                inner[m] = number

    def repeated(self, length: int) -> list[list[tuple[int, int]]]:
        """For each context, ranges (fewest, most) of bytes left of the anchor from which a repeated window starts.

        A window is repeated if and only if it lies in a maximal repeat, so the ranges are those of the groups.
        """
        found: list[list[tuple[int, int]]] = [[] for _ in self.rights]
        for extension, size, group in self.maximal(length):
            part = (max(length - size, 0), extension)
            for m in group:
                # Of nested groups of an interval the first has the longest extension.
                if not found[m] or found[m][-1][0] != part[0] or found[m][-1][1] < part[1]:
                    found[m].append(part)
        return found


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, ctx, n_contexts, at_most, at_least, left, right) of one occurrence of each wanted context."""
    schema = pa.schema([("h", pa.int64()), ("ctx", pa.int64()), ("n_contexts", pa.int64()), ("nearest", pa.int32()), ("left", pa.binary()), ("right", pa.binary())])
    per_text = wanted.groupBy("doc_id", "kid").agg(F.collect_list(F.struct("h", "ctx", "n_contexts", "at", "lo", "hi")).alias("places"))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = utf8(text)
                for p in places:
                    out.append((p["h"], p["ctx"], p["n_contexts"], p["at"] - p["hi"], data[p["lo"] : p["at"]], data[p["at"] : p["hi"] + length]))
                if len(out) > 20_000:
                    yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))
                    out = []
            if out:
                yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))

    joined = docs.join(per_text, ["doc_id", "kid"]).select("text", "places")
    return joined.mapInArrow(arrow_rows(run, schema), "h long, ctx long, n_contexts long, nearest int, left binary, right binary")


def grouped(rows: DataFrame, emit, schema: pa.Schema, ddl: str) -> DataFrame:
    """Feed the contexts of each anchor to emit(rows); a task holds one anchor's at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        now, held = None, []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != now:
                    if held:
                        out += emit(held)
                    now, held = row[0], []
                held.append(row)
            if len(out) > 20_000:
                yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))
                out = []
        if held:
            out += emit(held)
        if out:
            yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))

    return rows.select("h", "ctx", "nearest", "left", "right").repartition("h").sortWithinPartitions("h", "ctx").mapInArrow(arrow_rows(run, schema), ddl)


RANGES = "array<struct<fewest:int,most:int>>"


def tree_ranges(rows: DataFrame, length: int) -> DataFrame:
    """(h, ctx, ranges): which windows of each context repeat, from the interval trees."""
    pair = pa.struct([("fewest", pa.int32()), ("most", pa.int32())])
    schema = pa.schema([("h", pa.int64()), ("ctx", pa.int64()), ("ranges", pa.list_(pair))])

    def emit(held: list[tuple]) -> list[tuple]:
        found = Bucket([r[3] for r in held], [r[4] for r in held]).repeated(length)
        out = []
        for (h, ctx, nearest, left, _), ranges in zip(held, found, strict=True):
            ranges = [(max(a, nearest), min(b, len(left))) for a, b in ranges]
            if ranges := [{"fewest": a, "most": b} for a, b in set(ranges) if a <= b]:
                out.append((h, ctx, ranges))
        return out

    return grouped(rows, emit, schema, f"h long, ctx long, ranges {RANGES}")


def window_ranges(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: their windows are counted by hash."""
    import xxhash

    schema = pa.schema([("window", pa.string()), ("h", pa.int64()), ("ctx", pa.int64()), ("back", pa.int32())])

    def run(batches):
        for batch in batches:
            out = []
            for h, ctx, nearest, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                whole, size = left + right, len(left)
                out += [(xxhash.xxh3_128_hexdigest(whole[size - back : size - back + length]), h, ctx, back) for back in range(nearest, size + 1)]
                if len(out) > 50_000:
                    yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))
                    out = []
            if out:
                yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True))

    windows = table(rows.select("h", "ctx", "nearest", "left", "right").mapInArrow(arrow_rows(run, schema), "window string, h long, ctx long, back int"), "windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(twice, "window").groupBy("h", "ctx").agg(F.collect_list(F.struct(F.col("back").alias("fewest"), F.col("back").alias("most"))).cast(RANGES).alias("ranges"))


def places(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Anchors found twice or more, and their distinct contexts: (h, ctx, n, n_contexts, doc_id, kid, at, lo, hi)."""
    k = max(length // K_SHARE, 1)
    found = table(anchors(docs, length, k), "anchors")
    # Written first, so that the join deals both sides anew and can split a k-gram that very many texts share.
    twice = table(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "twice")
    repeated = table(found.join(twice, "h"), "repeated")
    discard(found, twice)
    distinct = repeated.groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "kid", "at", "lo", "hi")).alias("one"))
    distinct = table(distinct.select("h", "ctx", "n", "one.*"), "contexts")
    sizes = table(distinct.groupBy("h").agg(F.count("*").alias("n_contexts")), "sizes")
    return repeated, distinct.join(sizes, "h")


def maximal_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeat groups with all occurrences: (h, number, n_bytes, doc_id, start).

    A group is a string around an anchor, as far as the windows that the anchor stands for reach.
    """
    docs = with_key(docs, id_col, text_col)
    repeated, distinct = places(docs, length)
    rows = contexts(docs, distinct, length)
    schema = pa.schema([("h", pa.int64()), ("ctx", pa.int64()), ("number", pa.int32()), ("left", pa.int32()), ("n_bytes", pa.int32())])

    def emit(held: list[tuple]) -> list[tuple]:
        h = held[0][0]
        bucket = Bucket([r[3] for r in held], [r[4] for r in held])
        out = [(h, held[m][1], n, left, left + right) for n, (left, right, members) in enumerate(bucket.maximal(length)) for m in members]
        # A context by itself is a repeat if it is found twice; its occurrences come from the join below.
        return out + [(h, r[1], -1 - n, len(r[3]), len(r[3]) + len(r[4])) for n, r in enumerate(held)]

    groups = grouped(rows, emit, schema, "h long, ctx long, number int, left int, n_bytes int")
    found = repeated.join(groups, ["h", "ctx"]).select("h", "number", "n_bytes", "doc_id", (F.col("at") - F.col("left")).alias("start"))
    counts = found.groupBy("h", "number").agg(F.count("*").alias("n")).where("n > 1")
    return found.join(counts, ["h", "number"]).drop("n")


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kid, spans): byte ranges of each text of with_key() that lie in a repeated window, unmerged."""
    repeated, distinct = places(docs, length)
    distinct = table(distinct, "sized")
    open_ = distinct.where("n_contexts > 1")
    fetched = table(contexts(docs, open_, length), "fetched")
    ranges = tree_ranges(fetched.where(F.col("n_contexts") <= HOT), length)
    hot = fetched.where(F.col("n_contexts") > HOT)
    if hot.limit(1).count():
        ranges = ranges.unionByName(window_ranges(hot, length))
    verdict = distinct.join(ranges, ["h", "ctx"], "left").where("n > 1 or ranges is not null").select("h", "ctx", (F.col("n") > 1).alias("whole"), "ranges")
    # Written, so that the join below deals both its sides anew and a context of very many texts can be split in it.
    verdict = table(verdict, "verdicts")
    discard(distinct, fetched)
    whole = F.array(F.struct(F.col("lo").alias("start"), (F.col("hi") + length).alias("end")))
    part = F.transform("ranges", lambda r: F.struct((F.col("at") - r["most"]).alias("start"), (F.col("at") - r["fewest"] + length).alias("end")))
    marked = repeated.join(verdict, ["h", "ctx"]).select("doc_id", "kid", F.explode(F.when(F.col("whole"), whole).otherwise(part)).alias("span"))
    marked = table(marked, "spans")
    discard(repeated, verdict)
    return marked.groupBy("doc_id", "kid").agg(F.collect_set("span").alias("spans"))


def cut(data: bytes, found: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and how many maximal runs are gone."""
    merged: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in found or ()):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    kept, at = [], 0
    for start, end in merged:
        kept.append(data[at:start])
        at = end
    kept.append(data[at:])
    return b"".join(kept), len(merged)


def digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = with_key(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = utf8(text)
                kept, runs = cut(data, found)
                out.append((doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            yield dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)) if out else {n: [] for n in schema.names}

    joined = keyed.join(spans(keyed, length), ["doc_id", "kid"], "left").select("id", "text", "spans")
    return joined.mapInArrow(arrow_rows(run, schema), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def prune(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs with repeated bytes removed from the text; a character that is cut in two goes as a whole."""
    small_batches(docs.sparkSession)
    names, doc, kid, found_ = docs.columns, unused(docs, "doc"), unused(docs, "kid"), unused(docs, "spans")
    own = docs.withColumns({doc: F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))), kid: F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))})
    found = spans(with_key(docs, id_col, text_col), length).select(F.col("doc_id").alias(doc), F.col("kid").alias(kid), F.col("spans").alias(found_))
    joined = own.join(found, [doc, kid], "left").select(*names, found_)
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if not s else cut(utf8(t), s)[0].decode("utf-8", "ignore")
                for t, s in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)
            ]
            columns = [pa.array(texts, batch.schema.field(k).type) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(k) for k in range(len(names))]))

    return joined.mapInArrow(run, docs.schema)
