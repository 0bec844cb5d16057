"""MinHash near-dedup with sequential Bayesian verification.

1. Documents become sets of distinct word shingles; equal sets are one class, with one signature.
2. Signatures are banded; classes that share a band meet in a bucket.
3. In a bucket, pairs of classes are compared by batches of signature components. After each batch a pair goes whose
   posterior probability of reaching the threshold is under MISS / number of batches. Of the surviving pairs a bucket
   reports a spanning forest of the most similar, which is less than one pair a member: any other surviving pair is
   joined by it too. The components of all forests are the candidate groups.
4. In each candidate group all surviving classes are verified exactly on their full sets, against each other, until the
   group is one component; what is reported is again a forest, of verified links.
5. Buckets of more than BUCKET classes, and candidate groups of more than GROUP shingles, are dealt out to parts by
   hash, and the PIVOTS classes with the most links (or least hash) take part in each of them; a dealt-out group is dealt
   anew HOT_ROUNDS times, with the pivots that its links suggest. Whatever these links have not joined in such a bucket or
   group is then compared, or verified, in blocks of two parts, which cover every pair.

Nothing is collected but counts. Bands are sized for the threshold so that a pair at it misses all of them with a
probability of at most 1e-4.

Defined cases: a document without words has an empty set, links with nothing and stays; fewer words than a shingle are
one shingle; a null id stays null and is never a component's id unless all its ids are null; equal rows are in one class;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, discard, key_of, keyed, small_batches, table, unused, utf8
from .components import components
from .hashing import word_hashes

SHINGLE = 5
BATCHES, MISS = 7, 1e-3
BUCKET, PIVOTS = 1024, 8
#: Shingles that are verified in one place, but for a single larger pair, and rounds by pivots for groups with more.
GROUP, HOT_ROUNDS = 1_000_000, 3


def bands_for(threshold: float, miss: float = 1e-4, most: int = 128) -> tuple[int, int]:
    """Rows and bands: the most selective ones that miss a pair at the threshold so rarely, with so many hashes at most."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log(1 - threshold**rows))
        if rows * bands <= most:
            return rows, bands
    return 1, most


@functools.lru_cache(maxsize=4)
def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20240229))
    return random.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, n, np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    h = word_hashes(utf8(text).lower())
    if not len(h):
        return h
    n = max(len(h) - size + 1, 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """The least of each of n hash functions over a set."""
    a, b = multipliers(n)
    least = np.full(n, 2**32 - 1, np.uint32)
    for k in range(0, len(hashes), 2048):
        part = a[:, None] * hashes[None, k : k + 2048] + b[:, None]
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=1).astype(np.uint32))
    return least.astype(np.uint16)  # the low bits: equal for others by chance once in 65,536


def signatures(docs: DataFrame, n: int, size: int = SHINGLE) -> DataFrame:
    """Per document: key, doc_id, n_shingles, cid (128 bits of the set; null if empty), sig."""
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("n_shingles", pa.int64()), ("cid", pa.binary()), ("sig", pa.binary())])

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text, size)
                row = (doc_id, key, len(found), xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None, signature(found, n).tobytes() if len(found) else None)
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            yield out

    return docs.mapInArrow(arrow_rows(run, schema), "doc_id long, key string, n_shingles long, cid binary, sig binary")


def band_rows(classes: DataFrame, rows: int, bands: int) -> DataFrame:
    """(bucket, cid) of every band of every class."""
    import xxhash

    schema = pa.schema([("bucket", pa.int64()), ("cid", pa.binary())])

    def run(batches):
        for batch in batches:
            buckets, cids = [], []
            for cid, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                width = 2 * rows
                buckets += [xxhash.xxh3_64_intdigest(sig[k * width : (k + 1) * width], seed=k) - 2**63 for k in range(bands)]
                cids += [cid] * bands
            yield {"bucket": buckets, "cid": cids}

    return classes.select("cid", "sig").mapInArrow(arrow_rows(run, schema), "bucket long, cid binary")


def least_matches(threshold: float, n: int, batches: int = BATCHES, miss: float = MISS) -> list[tuple[int, int]]:
    """(components seen, fewest matches to go on) after each batch.

    With a uniform prior, the posterior after m matches of k is Beta(m + 1, k - m + 1), and its upper tail at the
    threshold is the chance of at most m successes in k + 1 trials.
    """
    out = []
    for batch in range(1, batches + 1):
        k = n * batch // batches
        tail, m = 0.0, -1
        while m < k:
            tail += math.comb(k + 1, m + 1) * threshold ** (m + 1) * (1 - threshold) ** (k - m)
            if tail >= miss / batches:
                break
            m += 1
        out.append((k, m + 1))
    return out


def compare(sigs: np.ndarray, limits: list[tuple[int, int]], others: np.ndarray | None = None) -> np.ndarray:
    """Matches of all pairs of rows, or of rows with others, -1 where a batch has ruled a pair out."""
    alive = ~np.eye(len(sigs), dtype=bool) if others is None else np.ones((len(sigs), len(others)), bool)
    others = sigs if others is None else others
    matches = np.zeros(alive.shape, np.int16)
    before = 0
    for seen, fewest in limits:
        if max(alive.shape) <= 64:
            matches += (sigs[:, None, before:seen] == others[None, :, before:seen]).sum(axis=2, dtype=np.int16)
        else:
            for k in range(before, seen):
                matches += sigs[:, k, None] == others[None, :, k]
        before = seen
        alive &= matches >= fewest
        if not alive.any():
            break
    return np.where(alive, matches, np.int16(-1))


def forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the most similar pairs; negative numbers are no edges (Prim's algorithm)."""
    out = []
    todo = np.ones(len(similar), bool)
    while todo.any():
        start = int(todo.argmax())
        todo[start] = False
        best, source = np.where(todo, similar[start], -1), np.full(len(similar), start)
        while (at := int(best.argmax())) >= 0 and best[at] >= 0:
            out.append((at, int(source[at])))
            todo[at] = False
            best[at] = -1
            nearer = todo & (similar[at] > best)
            best[nearer], source[nearer] = similar[at][nearer], at
    return out


def joins(similar: np.ndarray, roots: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) that join the roots of rows with those of columns, one for each two roots at most; negative numbers are no pairs."""
    rows, columns = np.nonzero((similar >= 0) & (roots[:, None] != others[None, :]))
    a, b = roots[rows].astype(np.int64), others[columns].astype(np.int64)
    _, first = np.unique(np.minimum(a, b) << 32 | np.maximum(a, b), return_index=True)
    return [(int(rows[k]), int(columns[k])) for k in first]


def numbered(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All members of some sets, put one after another as numbers from 0, and how often each number is found."""
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable").astype(np.int32)
    flat = flat[order]
    new = np.zeros(len(flat), np.int32)
    np.cumsum(flat[1:] != flat[:-1], out=new[1:])
    del flat
    out = np.empty(len(order), np.int32)
    out[order] = new
    return out, np.bincount(new)


def exact_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of the linked pairs of some sets: those with 100 * intersection >= percent * union."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    flat, shared = numbered(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Members that share the most go first: one that links with all the others ends the search.
    order = np.argsort(-np.add.reduceat(shared[flat], starts) / sizes, kind="stable")
    root = np.arange(n)
    out = []
    mark = np.zeros(len(shared), np.int32)
    for i in order.tolist():
        others = root != root[i]
        if not others.any():
            break
        own = flat[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        common = np.add.reduceat(mark[flat], starts)
        mark[own] = 0
        for j in np.flatnonzero(others & (100 * common >= percent * (sizes + sizes[i] - common))).tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def cross_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, root: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the linked pairs of a left and a right set whose roots differ; left, right and root are by set.

    Linked sets share one of their 100 - percent % rarest words at least (whatever is taken as their order, if it is the
    same for both), so only those that do are counted out.
    """
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    flat, count = numbered(sets)
    rank = np.empty(len(count), np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    ranked = rank[flat]
    words = [np.sort(ranked[end - n : end]) for n, end in zip(sizes, ends, strict=True)]
    prefix = [x[: len(x) + (-percent * len(x)) // 100 + 1] for x in words]
    at = np.flatnonzero(right)
    if not left.any() or not len(at):
        return []
    entries = np.concatenate([prefix[j] for j in at])
    order = np.argsort(entries, kind="stable")
    entries, holders = entries[order], np.repeat(at, [len(prefix[j]) for j in at])[order]
    root = root.copy()
    out = []
    mark = np.zeros(len(count), bool)
    for i in np.flatnonzero(left).tolist():
        low, high = np.searchsorted(entries, prefix[i], "left"), np.searchsorted(entries, prefix[i], "right")
        near = np.unique(np.concatenate([holders[a:b] for a, b in zip(low, high, strict=True) if a < b] or [at[:0]]))
        near = near[(root[near] != root[i]) & (100 * np.minimum(sizes[near], sizes[i]) >= percent * np.maximum(sizes[near], sizes[i]))]
        mark[words[i]] = True
        for j in near.tolist():
            if root[j] != root[i]:
                common = int(np.count_nonzero(mark[words[j]]))
                if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                    out.append((i, j))
                    root[root == root[j]] = root[i]
        mark[words[i]] = False
    return out


def by_part(rows: DataFrame, emit, batch: int = 20_000) -> DataFrame:
    """Feed each part of each group, rows (group, part, cid, payload), to emit(cids, payloads) and gather (a, b)."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        now, held = None, {}
        out: list[tuple[bytes, bytes]] = []

        def close() -> None:
            if len(held) > 1:
                cids = list(held)
                out.extend((max(cids[i], cids[j]), min(cids[i], cids[j])) for i, j in emit(list(held.values())))

        for part in batches:
            for group, number, cid, payload in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if (group, number) != now:
                    close()
                    now, held = (group, number), {}
                held[cid] = payload
            if len(out) > batch:
                yield {"a": [a for a, _ in out], "b": [b for _, b in out]}
                out.clear()
        close()
        if out:
            yield {"a": [a for a, _ in out], "b": [b for _, b in out]}

    dealt = rows.select("group", "part", "cid", "payload").repartition("group", "part").sortWithinPartitions("group", "part", "cid")
    return dealt.mapInArrow(arrow_rows(run, schema), "a binary, b binary").distinct()


def deal(members: DataFrame, turn: int, links: DataFrame | None = None) -> DataFrame:
    """(group, part, cid) of members (group, cid, parts): by hash, and each group's pivots in all its parts."""
    part = F.pmod(F.xxhash64("cid", "group", F.lit(turn)), F.col("parts"))
    dealt = members.select("group", F.when(F.col("parts") > 1, part).otherwise(F.lit(0)).cast("long").alias("part"), "cid")
    hot = members.where("parts > 1").withColumn("degree", F.lit(0))
    if links is not None:
        degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("degree"))
        hot = hot.drop("degree").join(degree, "cid", "left")
    first = Window.partitionBy("group").orderBy(F.desc_nulls_last("degree"), F.xxhash64("cid"))
    pivots = hot.withColumn("at", F.row_number().over(first)).where(f"at <= {PIVOTS}")
    every = pivots.select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "cid")
    return dealt.unionByName(every)


def blocks(members: DataFrame, links: DataFrame, weight: int) -> DataFrame:
    """(group, part, cid, home, root): all pairs of members that the links leave apart, in blocks of two parts each.

    members: (group, cid, n); a part, home, holds an n of about weight in all. Pairs within the largest component of a group
    are joined already, so its members have parts of their own, and every block has at least one part of other members.
    """
    rooted = table(members.join(components(links), F.col("cid") == F.col("node"), "left").select("group", "cid", "n", F.coalesce("root", "cid").alias("root")), "rooted")
    sums = rooted.groupBy("group", "root").agg(F.sum("n").alias("n"))
    most = sums.groupBy("group").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
    shape = most.select("group", F.col("top.root").alias("main"), F.ceil((F.col("all") - F.col("top.n")) / weight).cast("long").alias("others"), F.ceil(F.col("top.n") / weight).cast("long").alias("rest"))
    shape = table(shape.where("others > 0"), "shape")
    is_main = F.col("root") == F.col("main")
    homes = rooted.join(shape, "group").select(
        "group", "cid", "root", "others", (F.col("others") + F.col("rest")).alias("all"), is_main.alias("main"),
        F.when(is_main, F.col("others") + F.pmod(F.xxhash64("cid", "group"), F.col("rest"))).otherwise(F.pmod(F.xxhash64("cid", "group"), F.col("others"))).alias("home"),
    )
    met = homes.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("main"), F.col("others")).otherwise(F.col("all")) - 1)))
    return met.select("group", (F.least("home", "with") * F.col("all") + F.greatest("home", "with")).alias("part"), "cid", "home", "root")


def sides(members: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's members: which are on its left and on its right, and numbers for their roots."""
    home = np.array([x["home"] for x in members])
    return home == home.min(), home == home.max(), np.unique([x["root"].hex() for x in members], return_inverse=True)[1]


def candidate_groups(members: DataFrame, sigs: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """(cid, group): the components of what the buckets report. members: (group, cid, parts) by bucket."""
    rows = deal(members, 0).join(sigs, "cid").withColumnRenamed("sig", "payload")

    def emit(payloads: list[bytes]) -> list[tuple[int, int]]:
        return forest(compare(np.stack([np.frombuffer(x, np.uint16) for x in payloads]), limits))

    found = by_part(rows, emit)
    hot = table(members.where("parts > 1").select("group", "cid", F.lit(1).cast("long").alias("n")), "hot")
    if hot.limit(1).count():
        found = table(found, "near-links")

        def across(payloads: list[dict]) -> list[tuple[int, int]]:
            left, right, root = sides(payloads)
            sigs = np.stack([np.frombuffer(x["sig"], np.uint16) for x in payloads])
            i, j = np.flatnonzero(left), np.flatnonzero(right)
            return [(int(i[a]), int(j[b])) for a, b in joins(compare(sigs[i], limits, sigs[j]), root[i], root[j])]

        met = blocks(hot, found, BUCKET).join(sigs, "cid")
        found = found.unionByName(by_part(met.select("group", "part", "cid", F.struct("home", "root", "sig").alias("payload")), across))
    return components(found).select(F.col("node").alias("cid"), F.col("root").alias("group"))


def verified_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest of the exact links of each group. sets: (cid, n, shingles)."""
    sized = table(groups.join(sets.select("cid", "n"), "cid"), "sized")
    parts = sized.groupBy("group").agg(F.ceil(F.sum("n") / GROUP).cast("long").alias("parts"))
    members = table(sized.join(parts, "group").select("group", "cid", "parts"), "groups")

    def emit(payloads: list[bytes]) -> list[tuple[int, int]]:
        return exact_links([np.frombuffer(x, np.uint64) for x in payloads], percent)

    links: DataFrame | None = None
    for turn in range(HOT_ROUNDS):
        rows = deal(members if turn == 0 else members.where("parts > 1"), turn, links)
        found = table(by_part(rows.join(sets.select("cid", F.col("shingles").alias("payload")), "cid"), emit), "links")
        links = found if links is None else links.unionByName(found)
        if turn == 0 and not members.where("parts > 1").limit(1).count():
            return links
    hot = sized.join(members.where("parts > 1"), ["group", "cid"], "left_semi").select("group", "cid", "n")
    met = blocks(hot, links, GROUP // 2).join(sets.select("cid", "shingles"), "cid")

    def across(payloads: list[dict]) -> list[tuple[int, int]]:
        left, right, root = sides(payloads)
        return cross_links([np.frombuffer(x["shingles"], np.uint64) for x in payloads], left, right, root, percent)

    rows = met.select("group", "part", "cid", F.struct("home", "root", "shingles").alias("payload"))
    return links.unionByName(table(by_part(rows, across), "links"))


def full_sets(docs: DataFrame, classes: DataFrame, cids: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(cid, n, shingles): the full set of each class, from the text of one of its documents."""
    wanted = classes.join(cids, "cid", "left_semi").select("cid", "key")
    schema = pa.schema([("cid", pa.binary()), ("n", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            found = [shingles(t, size) for t in batch.column(1).to_pylist()]
            yield {"cid": batch.column(0), "n": [len(x) for x in found], "shingles": [x.tobytes() for x in found]}

    return docs.select("key", "text").join(wanted, "key").select("cid", "text").mapInArrow(arrow_rows(run, schema), "cid binary, n long, shingles binary").dropDuplicates(["cid"])


def classified(docs: DataFrame, percent: int, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Signatures of keyed() documents, and (cid, root, component_id) of each class: its group and the group's least id."""
    rows, bands = bands_for(percent / 100)
    limits = least_matches(percent / 100, rows * bands)
    sigs = table(signatures(docs, rows * bands, size), "signatures")
    filled = sigs.where("cid is not null")
    classes = table(filled.groupBy("cid").agg(F.min(F.struct("doc_id", "key")).alias("least"), F.min("doc_id").alias("id")).select("cid", "id", "least.key"), "classes")
    # Buckets with two classes or more: the bands are worked out twice rather than stored.
    banded = band_rows(filled, rows, bands)
    mark = F.xxhash64("cid")
    several = table(banded.groupBy("bucket").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low < high").select("bucket"), "buckets")
    met = table(banded.join(several, "bucket").distinct(), "met")
    sizes = table(met.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET).cast("long").alias("parts")), "sizes")
    # Written, so that nothing stands on the join and a hot bucket can be split in it.
    members = table(met.join(sizes, "bucket").select(F.col("bucket").alias("group"), "cid", "parts"), "members")
    near = table(filled.join(classes.join(met.select("cid").distinct(), "cid", "left_semi").select("key"), "key", "left_semi").select("cid", "sig").dropDuplicates(["cid"]), "near")
    discard(several, met, sizes)
    groups = table(candidate_groups(members, near, limits), "candidates")
    discard(members, near)
    sets = table(full_sets(docs, classes, groups.select("cid"), size), "sets")
    roots = table(components(verified_links(groups, sets, percent)), "roots")
    discard(groups, sets)
    grouped = classes.select("cid", "id").join(roots, classes.cid == roots.node).select("cid", "root", "id")
    joined = grouped.join(grouped.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("cid", "root", "component_id")
    alone = classes.select("cid", F.col("id").alias("class_id"))
    found = alone.join(joined, "cid", "left").select("cid", F.coalesce("root", "cid").alias("root"), F.coalesce("component_id", "class_id").alias("component_id"))
    return sigs, table(found, "components")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, key, n_shingles, component_id, kept."""
    sigs, component = classified(keyed(docs, id_col, text_col), percent, size)
    return sigs.select("doc_id", "key", "n_shingles", "cid").join(component, "cid", "left").select(
        "doc_id", "key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def survivors(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group, and every other row, with all columns of docs.

    The row that stays is one with the least id (null last), and of these with the least hash of its text. A row without
    words is in no group, so all of them stay, repeated ones too; equal worded rows are one group and one of them stays.
    Rows with a null id are grouped by their texts like all others.
    """
    small_batches(docs.sparkSession)
    sigs, component = classified(keyed(docs, id_col, text_col), percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key"))
    kept = sigs.where("cid is not null").join(component, "cid").groupBy("root").agg(first.alias("first")).select("first.key")
    key, text = unused(docs, "key"), F.col(text_col).cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.where(worded).withColumn(key, key_of(F.col(id_col).cast("long"), text))
    return own.join(kept.withColumnRenamed("key", key), key).dropDuplicates([key]).select(*docs.columns).unionByName(docs.where(~worded))
