"""Training-data operators against plain versions, and on odd tables."""

import array
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from lexloom.llm import ann, bpe, chat, neardup, packing, pii, quality, suffix, toxicity, warc

BYTES, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "tie tie"), (4, "tie tie"), (None, "no id here"), (5, "x" * 3000), (6, "ü漢😀 \x1c\x85 end"), (7, "long " * 3000)]


def frame(spark, rows):
    """Rows with extra columns of clashing names."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("key", "kept", "score", "spans", "cid", "at", "n", "id", "h"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs.repartition(3)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def mixed():
    random.seed(4)
    base = [f"w{random.randint(0, 999)}" for _ in range(120)]
    rows = [(n, " ".join(random.choice(base) for _ in range(random.randint(0, 90)))) for n in range(40)]
    for n in range(40, 90):
        words = list(base)
        for _ in range(random.randint(0, 4)):
            words[random.randrange(len(words))] = f"z{random.randint(0, 10**6)}"
        rows.append((n, " ".join(words)))
    return rows


OPERATORS = {
    "toxicity": lambda d: toxicity.score(d, toxicity.Model(toxicity.seeds())), "suffix": suffix.digests, "bpe": lambda d: bpe.digests(d, BYTES, P.PATTERN), "quality": quality.quality,
    "packing": lambda d: packing.pack(d, WORDS), "pii": lambda d: pii.pseudonymise(d, "k"), "neardup": neardup.near_duplicates, "survivors": neardup.survivors, "prune": suffix.prune, "repeats": suffix.maximal_repeats,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_and_empty_tables(spark, name):
    run = OPERATORS[name]
    assert run(frame(spark, ODD).where("false")).count() == 0
    found = run(frame(spark, ODD))
    wanted = {"packing": None, "repeats": None, "survivors": len(ODD) - 1}.get(name, len(ODD))
    assert wanted is None or found.count() == wanted
    if name in ("pii", "prune", "survivors"):
        assert {"key", "kept", "spans"} <= set(found.columns)


def test_bpe_is_what_tiktoken_gives(spark):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BYTES), special_tokens={})
    random.seed(7)
    letters = " \t\n\x1c\x85\xa0 ab'sdtlABC1²½é,.!ー漢"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 16))) for _ in range(3000)] + ["a" * k for k in range(60)] + ["thethethe" * 40, "=-" * 300]
    codec = bpe.codec(BYTES, P.PATTERN)
    assert [array.array("I", x).tolist() for x in codec.encode_block(texts)] == [known.encode_ordinary(t) for t in texts]
    rows = {r.doc_id: r for r in bpe.encode(frame(spark, ODD[:3] + ODD[6:]), BYTES, P.PATTERN).collect()}
    assert rows[7].ids == known.encode_ordinary("long " * 3000) and bytes(rows[7].decoded) == b"long " * 3000


def test_quality_counts():
    text = "a b c\nd e\nd e\n a b c ## $\n\n"
    found = quality.measure(text)
    assert (found["n_words"], found["word_chars"], found["n_symbols"], found["n_dup_lines"]) == (12, 13, 3, 1)
    words = text.encode().split()
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = collections.Counter(windows)
    assert found["n_repeat_words"] == len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)})
    random.seed(3)
    prose = " ".join("".join(random.choice("etaoinshrdlu") for _ in range(random.randint(2, 9))) for _ in range(400))
    assert quality.measure(prose)["kept"] and not quality.measure("buy now cheap " * 400)["kept"]
    noise = " ".join("".join(chr(random.randint(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(400))
    assert quality.measure(prose + prose[:100])["kept"] and not quality.measure("z" * 60 + " " + "ab " * 60 + "y" * 9000)["kept"] and quality.measure(noise)["ratio"] < 1.6


def test_packing_is_gapless_and_tight(spark, mixed):
    from tokenizers import Tokenizer

    rows = [*mixed, (500, "big words here " * 3000), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = packing.pack(docs, WORDS).collect()
    known = Tokenizer.from_file(WORDS)
    ids = {k: [*known.encode(t or "", add_special_tokens=False).ids, 1] for k, t in rows}
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    for k, parts in pieces.items():
        assert sum(n for _, n in parts) == len(ids[k])
    total = sum(map(len, ids.values()))
    assert len(sequences) <= total / packing.WINDOW * 1.25 + 2


def test_bounded_space():
    packer = packing.Packer(3, window=10, open_windows=2)
    out = [p for n in (6, 7, 8, 3, 2) for p in packer.add(n, b"\1\0\0\0" * n)]
    assert len(packer.open) <= 2 and len(out) + len(packer.close()) == 5 and {p[5] >> packing.SHIFT for p in out} == {3}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    texts = ["card 4405935324758010, ip 16.120.181.235.", "again 4405 9353 2475 8010 and 4405935324758011", "+1 (866) 555-4354 or bob.42@mail8.example.com", "2021-02-28 28.02.2021 02/28/2021 2021-02-30", "078-05-1120 and 000-05-1120", "DE89370400440532013000 +44 20 7946 0958", "version 2.0 of 12 things"]
    rows = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").collect()}
    card = rows[0].text.split()[1].rstrip(",")
    assert card != "4405935324758010" and luhn(card) and card.startswith("4") and rows[1].text.split()[1:5] == [card[k : k + 4] for k in (0, 4, 8, 12)]
    assert rows[1].text.endswith("4405935324758011")  # not valid, so left
    assert all(0 <= int(x) < 256 for x in rows[0].text.split()[-1].rstrip(".").split("."))
    assert "866" not in rows[2].text and rows[2].text.endswith("@mail8.example.com") and "bob.42" not in rows[2].text
    a, b, c, d = rows[3].text.split()
    assert a != "2021-02-28" and b == ".".join(reversed(a.split("-"))) and c == f"{a[5:7]}/{a[8:]}/{a[:4]}" and d == "2021-02-30"
    assert rows[4].text.endswith("000-05-1120") and not rows[4].text.startswith("078-05-1120")
    iban = rows[5].text.split()[0]
    assert int("".join(str(int(x, 36)) for x in iban[4:] + iban[:4])) % 97 == 1 and "7946" not in rows[5].text
    assert rows[6].text == texts[6] and rows[6].pii_values == 0
    many = spark.range(3000).selectExpr("id as doc_id", "concat('10.0.', id div 250, '.', id % 250) as text")
    assert pii.pseudonymise(many, "key").select("text").distinct().count() == 3000  # a permutation
    assert "Python" not in pii.pseudonymise(many, "key")._jdf.queryExecution().toString()


def brute_groups(rows, percent):
    sets = [set(map(int, neardup.shingles(t))) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common) and root[i] != root[j]:
                old = root[i]
                root = [root[j] if r == old else r for r in root]
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return {rows[k][0]: least[r] for k, r in enumerate(root)}


@pytest.mark.parametrize(("percent", "small"), [(85, False), (80, True)])
def test_near_duplicates_match_brute_force(spark, mixed, percent, small, monkeypatch):
    if small:  # every bucket and group is dealt out to parts
        monkeypatch.setattr(neardup, "BUCKET", 16)
        monkeypatch.setattr(neardup, "GROUP", 2000)
    rows = [*mixed, (300, "a b"), (301, "A  b"), (302, mixed[50][1].upper().lower())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, percent).collect()} == brute_groups(rows, percent)
    kept = neardup.survivors(docs, percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*brute_groups(rows, percent).values()})


def test_large_groups_are_verified_in_full(spark, monkeypatch):
    """A family around a template, 0.74 alike, in which 40 pairs are 0.9 alike: its parts are many, so few of these meet by chance."""
    monkeypatch.setattr(neardup, "GROUP", 1000)
    random_ = np.random.Generator(np.random.PCG64(8))
    template = random_.integers(0, 2**63, 85, np.uint64)
    sets = [np.unique(np.concatenate([template, random_.integers(0, 2**63, 15, np.uint64)])) for _ in range(300)]
    for k in range(40):
        sets[k + 40] = np.unique(np.concatenate([np.setdiff1d(sets[k], template)[3:], template, random_.integers(0, 2**63, 3, np.uint64)]))
    cids = [b"%016d" % k for k in range(300)]
    groups = spark.createDataFrame([(c, b"g") for c in cids], "cid binary, group binary").repartition(3)
    full = spark.createDataFrame([(c, len(x), x.tobytes()) for c, x in zip(cids, sets, strict=True)], "cid binary, n long, shingles binary")
    found = {(bytes(r.a), bytes(r.b)) for r in neardup.verified_links(groups, full, 85).collect()}
    assert found == {(cids[k + 40], cids[k]) for k in range(40)}


def test_large_buckets_are_compared_in_full(spark, monkeypatch):
    """Signatures of one bucket and many parts that share half of their components, and 40 pairs that share nearly all."""
    monkeypatch.setattr(neardup, "BUCKET", 8)
    random_ = np.random.Generator(np.random.PCG64(9))
    template = random_.integers(0, 2**16, 120, np.uint16)
    sigs = np.where(random_.random((240, 120)) < 0.5, template, random_.integers(0, 2**16, (240, 120), np.uint16))
    sigs[40:80] = sigs[:40]
    sigs[40:80, ::12] += np.uint16(1)
    cids = [b"%016d" % k for k in range(240)]
    members = spark.createDataFrame([(5, c, 30) for c in cids], "group long, cid binary, parts long").repartition(3)
    known = spark.createDataFrame([(c, x.tobytes()) for c, x in zip(cids, sigs, strict=True)], "cid binary, sig binary")
    groups = collections.defaultdict(set)
    for r in neardup.candidate_groups(members, known, neardup.least_matches(0.85, 120)).collect():
        groups[bytes(r.group)].add(bytes(r.cid))
    assert {frozenset(x) for x in groups.values()} == {frozenset((cids[k], cids[k + 40])) for k in range(40)}


def brute_cut(rows, length):
    seen = collections.Counter(t[k : k + length] for _, t in rows for k in range(len(t) - length + 1))
    out = {}
    for i, t in rows:
        gone = np.zeros(len(t) + 2, int)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k + 1 : k + length + 1] = 1
        kept = bytes(c for c, g in zip(t, gone[1:-1], strict=True) if not g)
        out[i] = (len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 3])
def test_suffix_dedup_matches_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    random.seed(2)
    text = "".join(random.choice("abcd") for _ in range(800))
    rows = [(n, "".join(random.choice("abcd") for _ in range(random.randint(0, 60)))) for n in range(40)]
    for n in range(40, 120):
        at = random.randint(0, 700)
        part = list(text[at : at + random.randint(10, 90)])
        if random.random() < 0.6:
            part[random.randrange(len(part))] = "é"
        rows.append((n, "".join(random.choice("xyz") for _ in range(random.randint(0, 9))) + "".join(part)))
    rows += [(200, "q" * 300), (201, "pq" * 99), (202, "w" * 20), (203, "w" * 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: tuple(r)[1:] for r in suffix.digests(docs, 20).collect()}
    assert found == brute_cut([(i, t.encode()) for i, t in rows], 20)


def test_interval_tree_reports_maximal_repeats():
    bucket = suffix.Bucket([b"xx", b"yx", b"zz"], [b"abcd", b"abce", b"abff"])
    assert {(left, right, tuple(sorted(m))) for left, right, m in bucket.maximal(2)} == {(1, 3, (0, 1)), (0, 2, (0, 1, 2))}
    assert sorted(suffix.intervals([2, 0, 3])) == [(0, 0, 3), (2, 0, 1), (3, 2, 3)]


def test_maximal_repeats_list_all_occurrences(spark):
    passage = "the quick brown fox jumps over it"
    rows = [(1, "aaaa " + passage + " bbbb"), (2, "cccc " + passage + " dddd"), (3, passage + "!")]
    found = suffix.maximal_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    groups = collections.defaultdict(set)
    for r in found:
        groups[r.h, r.number].add((r.doc_id, rows[r.doc_id - 1][1].encode()[r.start : r.start + r.n_bytes]))
    assert groups and all(len({t for _, t in g}) == 1 for g in groups.values()) and any({i for i, _ in g} == {1, 2, 3} for g in groups.values())


def test_nearest_neighbours(spark):
    random_ = np.random.Generator(np.random.PCG64(5))
    x = random_.standard_normal((600, 24)).astype(np.float32)
    x[400:450] = x[7]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None] * 24), (904, [1.0]), (None, [1.0] * 24)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    found = collections.defaultdict(list)
    for r in ann.search(table, table.where("vec_id % 50 = 0")).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        near = unit @ unit[q]
        near[q] = -9
        best = np.lexsort((np.arange(600), -np.round(near, 12)))[:5]
        got = sorted(found[q])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and all(abs(near[g[1]] - g[2]) < 1e-12 for g in got)
        hits += len({g[1] for g in got} & set(best.tolist()))
    assert hits >= 0.9 * 60 and [g[1] for g in sorted(found[400])] == [7, 401, 402, 403, 404]
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert ann.search(few, few).count() == 6 and ann.search(few.where("false"), few).count() == 0


def test_small_lists_are_topped_up(spark, monkeypatch):
    """One list visited, and the query is alone in it."""
    x = np.random.Generator(np.random.PCG64(3)).standard_normal((60, 8)).astype(np.float32) * 0.01 + np.eye(8, dtype=np.float32)[0]
    x[0] = np.eye(8)[5]
    fitted = ann.fit

    def fit(*args):
        index = fitted(*args)
        index.centroids, index.n_probe = index.prepare(x[:2]), 1
        return index

    monkeypatch.setattr(ann, "fit", fit)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    near = x.astype(float) @ x[0] / np.linalg.norm(x.astype(float), axis=1)
    found = ann.search(table, table.where("vec_id = 0")).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [k for k in np.argsort(-near).tolist() if k][:5]


def test_toxicity_reads_clauses(spark):
    model = toxicity.Model(toxicity.seeds())
    score = model.score
    assert score("you are an idiot and a moron.") > score("they are not an idiot here.") > score("a quiet day.")
    assert score("you idiot.") > score("she said idiot was a word.") and score(None) == score("")
    symbol = toxicity.GRAMMAR.start, 0
    state, *_ = toxicity.GRAMMAR.step(symbol[0], toxicity.TARGET_)
    assert toxicity.GRAMMAR.step(state, toxicity.INSULT_)[1] & toxicity.TARGETED
    random.seed(6)
    calm = [f"k{random.choice('abcdef')}{random.choice('uvw')}" for _ in range(40)]
    rows, labels = [], []
    for n in range(400):
        words, toxic = random.choices(calm, k=40), n % 4 == 0
        if toxic:
            words[3], words[9], words[20] = (f"grumf{random.choice('abc')}" for _ in range(3))
        rows.append((n, " ".join(words)))
        labels.append((n, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, known))
    held = [r for r in got.join(known, "doc_id").collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held) and sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    assert toxicity.train(docs, known.where("false")).weights == toxicity.PRIOR


def test_chat_keeps_the_longest(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (3, 5, "user", "a"), (4, 0, "user", "x"), (4, 0, "user", "x"), (5, 0, None, None), (6, 0, "user", "x"), (None, 0, "user", "z")]
    rows = {r.conv_id: r for r in chat.chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("hash", F.lit(1))).collect()}
    assert set(rows) == {2, 4, 5} and rows[4].n_equal == 2 and rows[4].n_turns == 1
    assert rows[2].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n" and rows[5].rendered == "<|im_start|>user\n<|im_end|>\n"


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 60_000
    rows = [(1, "http://a/", "x" * 1500), (2, None, "x" * 1500), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", "x" * 1500), (6, "u", big), (7, "u v", big), (8, "u", "\r\nWARC/1.1\r\n\r\n" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    found = {r.page_id: tuple(r)[1:] for r in warc.round_trip(pages).collect()}
    digest = {k: hashlib.sha1((h or "").encode()).hexdigest() for k, _, h in rows}
    assert {k: v[:2] for k, v in found.items()} == {k: (len((h or "").encode()), digest[k]) for k, _, h in rows}
    assert {k: v[2:] for k, v in found.items()} == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None), None: ("response", None), 6: ("revisit", 7), 7: ("response", None), 8: ("response", None)}
    parts = warc.chunks(warc.write(pages)).where("page_id = 7").orderBy("chunk").collect()
    assert len(parts) > 2 and b"".join(bytes(p.data) for p in parts) == big.encode() and parts[-1].digest == digest[7] and max(len(p.data) for p in parts) <= warc.CHUNK
    assert warc.round_trip(pages.where("false")).count() == 0


@pytest.mark.parametrize("block", [40, 250_000])
def test_components_in_several_tasks_and_in_one(spark, monkeypatch, block):
    """A chain, a hub, random edges and a loop, against a plain search."""
    from lexloom.llm import components

    monkeypatch.setattr(components, "BLOCK", block)
    random = np.random.default_rng(1)
    edges = [(k, k + 1) for k in range(100)] + [(1000, k) for k in range(1001, 1100)] + random.integers(200, 900, (300, 2)).tolist() + [(1200, 1200), (5, 6)]
    near: dict[int, set[int]] = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want: dict[int, int] = {}
    for start in sorted(near):
        todo = [] if start in want else [start]
        while todo:
            node = todo.pop()
            if node not in want:
                want[node] = start
                todo += near[node]
    as_bytes = lambda n: n.to_bytes(2, "big")
    found = components.components(spark.createDataFrame([(as_bytes(a), as_bytes(b)) for a, b in edges], "a binary, b binary")).collect()
    assert sorted((int.from_bytes(r.node), int.from_bytes(r.root)) for r in found) == sorted(want.items())
    assert components.components(spark.createDataFrame([], "a binary, b binary")).count() == 0
