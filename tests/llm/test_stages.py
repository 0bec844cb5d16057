"""Operators and pipeline stages against plain versions, and on odd rows."""

import datetime
import hashlib
import hmac
import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexloom.llm import bpe, neardup, packing, pii, quality, suffix, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text, size=5):
    words = text.lower().split()
    return {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))} if words else set()


def test_survivors_keep_every_row_that_is_no_copy(spark):
    random.seed(3)
    text = lambda: " ".join(f"w{random.randrange(999)}" for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, a, 1), (None, b, 2), (None, c, 3), (5, d, 4), (5, d, 4), (9, d + " end", 5), (None, d, 6), (7, "", 7), (7, "", 7), (8, None, 8), (8, " \t", 9), (5, a, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int").withColumn("cid", F.lit("x"))
    found = neardup.survivors(docs, 80)
    assert sorted(r.key for r in found.collect()) == [2, 3, 4, 7, 7, 8, 9, 10] and found.columns == docs.columns


def test_a_chain_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP", 600)
    random.seed(4)
    words = [f"v{k}" for k in range(400)]
    rows = [(n, " ".join(words[3 * n : 3 * n + 120])) for n in range(40)]  # neighbours are 0.95 alike, distant ones not at all
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1


def permuted(key, tag, left, right, radix_left, radix_right):
    """The Feistel network in plain Python."""
    secret = hmac.new(key.encode(), b"pseudonyms/" + tag.encode(), "sha256").hexdigest()
    bits = lambda i, x: int(hashlib.sha256(f"{secret}|{i}|{x}".encode()).hexdigest()[:12], 16)
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            left = (left + bits(i, right)) % radix_left
        else:
            right = (right + bits(i, left)) % radix_right
    return left, right


def test_pseudonyms_match_a_plain_feistel(spark):
    dates = ["0001-01-01", "0199-12-31", "0200-01-01", "1750-03-12", "1999-12-31", "2205-01-01", "9799-12-31", "9800-01-01", "9999-12-31"]
    rows = [(n, f"born {d}, seen.") for n, d in enumerate(dates)] + [(90, "id 123-45-6789 ok"), (91, "from 10.0.0.7 now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pii_found": F.lit(1), "pii_made": F.lit(2)})
    out = pii.pseudonymise(docs, "k")
    assert {"pii_found", "pii_made"} <= set(out.columns) and not any("pseudonyms" in x or "'k'" in x for x in out._jdf.queryExecution().toString().split())
    got = {r.doc_id: r.text for r in out.collect()}

    def day(text):
        d, first = datetime.date.fromisoformat(text), datetime.date.fromisoformat(pii.FIRST_DAY)
        since = (d - first).days
        (a, b), base = (pii.DAYS, since // pii.SPAN * pii.SPAN) if 0 <= since < pii.SPANS * pii.SPAN else (pii.DAYS_BEFORE, -72_683) if since < 0 else (pii.DAYS_AFTER, pii.SPANS * pii.SPAN)
        left, right = permuted("k", "date", (since - base) // b, (since - base) % b, a, b)
        return (first + datetime.timedelta(base + left * b + right)).isoformat()

    assert [got[n] for n in range(len(dates))] == [f"born {day(d)}, seen." for d in dates]
    left, right = permuted("k", "ssn", 122, 44 * 9999 + 6788, 898, 99 * 9999)
    assert got[90] == f"id {left + (2 if left >= 665 else 1):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d} ok"
    left, right = permuted("k", "ip", 2560, 7, 65536, 65536)
    assert got[91] == f"from {left >> 8}.{left & 255}.{right >> 8}.{right & 255} now"


def test_quality_matches_a_plain_version():
    import zstandard

    random.seed(5)
    prose = " ".join("".join(random.choices("etaoinshrdlu", k=random.randrange(2, 9))) for _ in range(900))
    noise = "".join(chr(random.randrange(33, 126)) for _ in range(2500))
    size = lambda b: len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))
    for text in (prose, prose[:2500], prose[:2047], prose[:3000] + " " + noise, " ".join([noise[k : k + 7] for k in range(0, 2500, 7)] * 3), "", None, prose[:500]):
        found, data = quality.measure(text), (text or "").encode()
        low, high = [b[1:] for b in quality.BANDS if len(data) >= b[0]][-1]
        parts = [data[k : k + 2048] for k in range(0, len(data) - 2047, 2048)] + ([data[-2048:]] if len(data) > 2048 and len(data) % 2048 else [])
        bad = sum(not 1.30 <= size(p) <= 3.2 for p in parts)
        fine = low <= (size(data) if data else 0.0) <= high and bad <= 0.25 * len(parts)
        assert (found["n_chunks"], found["n_bad_chunks"], found["kept"]) == (len(parts), bad, not found["base_failed"] and fine)


def plain_match(words):
    """Pattern and weight of a clause, read without any machine."""
    weight, kinds = 0.0, []
    target = report = stack = False
    negated = intent = 0
    for w in words:
        if w in toxicity.SEEDS:
            kind, own = toxicity.SEEDS[w]
            marks = {"t": target, "n": negated > 0, "r": report}
            factor = (1.5 if target else 1) * (0.25 if negated else 1) * (0.5 if report else 1)
            if kind == toxicity.INSULT_ and not (marks["n"] or marks["r"]):
                factor *= 1.25 if stack else 1
                stack = True
            marks["i"] = kind == toxicity.THREAT_ and intent > 0
            factor *= 1.5 if marks["i"] else 1
            weight += own * factor
            kinds.append(marks)
        kind = toxicity.CUES.get(w, (toxicity.OTHER_, 0))[0] if w not in toxicity.SEEDS else None
        target |= kind == toxicity.TARGET_
        report |= kind == toxicity.REPORTED_
        negated = toxicity.SCOPE if kind == toxicity.NEGATION_ else max(negated - 1, 0)
        intent = toxicity.REACH if kind == toxicity.INTENT_ else max(intent - 1, 0)
    plain = [m for m in kinds if not (m["n"] or m["r"])]
    if not kinds:
        return None
    if not plain:
        return (0 if all(m["n"] for m in kinds) else 1), weight
    return 2 if any(m["t"] for m in plain) else 3 if any(m["i"] for m in plain) else 4 if len(plain) > 1 else 5, weight


def test_the_grammar_matches_a_plain_reader():
    lexicon = toxicity.seeds()
    vocabulary = ["idiot", "moron", "kill", "you", "not", "said", "will", "tree", "house"]
    random.seed(6)
    for words in itertools.chain(itertools.product(vocabulary, repeat=3), (random.choices(vocabulary, k=9) for _ in range(3000))):
        found, wanted = toxicity.match(" ".join(words), lexicon), plain_match(words)
        assert (found is None) == (wanted is None) and (found is None or (found[0] == wanted[0] and abs(found[1] - wanted[1]) < 1e-9)), words
    assert toxicity.Model(lexicon).score("a tree, an idiot, a house.") == pytest.approx(toxicity.Model(lexicon).score("a tree."))


def test_long_words_take_linear_time():
    import public_tokenizers
    import tiktoken

    codec = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for text in ("a" * 20_000, "ab" * 5_000 + "the" * 3_000, "7" * 3_001, "é" * 2_000, "z" * 1_000_000):
        ids = memoryview(codec.encode_block([text])[0]).cast("I").tolist()
        assert b"".join(map(codec.vocabulary.__getitem__, ids)) == text.encode()
        if len(text) < 100_000:
            assert ids == coder.encode(text, disallowed_special=())


def test_special_tokens_are_what_tokenizers_gives():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|>", "Plain Text é Σ", ""]
    got = packing.WordCodec(path).ids(texts)
    assert [memoryview(g).cast("I").tolist() if g else [] for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture()
def odd(spark, tmp_path):
    """Odd rows for every stage, in a folder with labels."""
    random.seed(8)
    prose = lambda n: " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(n))
    passage = prose(60)
    rows = [
        (1, prose(50), "en", "s", 1), (2, None, "en", "s", 2), (3, "", None, None, None), (3, "", None, None, None), (None, prose(40), "en", "s", 3), (4, "you idiot, you moron. you will be trash. " * 3, "en", "s", 4),
        (5, prose(20) + " " + passage, "en", "s", 5), (6, passage + " " + prose(25), "en", "s", 6), (7, "call 212-555-0123 or 10.1.2.3 " + prose(9), "en", "s", 7), (8, "x" * 300_000, "en", "s", 8), (9, prose(30), "en", "s", 9),
    ]
    rows += [(10, rows[-1][1], "en", "s", 9), (9, rows[-1][1], "en", "s", 9)]
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.createDataFrame(rows, DOCS).repartition(3), str(tmp_path), passage


def test_stages_on_odd_rows(spark, odd):
    docs, folder, passage = odd
    every = docs.collect()
    stage = dict(corpus_pipeline.STAGES)
    calm = stage["toxicity"](spark, docs, folder).collect()
    model = toxicity.Model(toxicity.seeds())
    assert sorted(map(str, calm)) == sorted(str(r) for r in every if model.score(r.text) < 0.5) and 4 not in {r.doc_id for r in calm}
    kept = stage["near_dedup"](spark, docs, folder).collect()
    worded = [r for r in every if (r.text or "").strip()]
    groups: list[set[int]] = []
    for k, r in enumerate(worded):
        near = [g for g in groups if any(5 * len(shingle_set(worded[j].text) & shingle_set(r.text)) >= 4 * len(shingle_set(worded[j].text) | shingle_set(r.text)) for j in g)]
        groups = [g for g in groups if g not in near] + [set().union({k}, *near)]
    wanted = [min((worded[k] for k in g), key=lambda r: (r.doc_id is None, r.doc_id)) for g in groups] + [r for r in every if not (r.text or "").strip()]
    assert sorted(map(str, kept)) == sorted(map(str, wanted))
    cut = {str((r.doc_id, r.lang)): r.text for r in stage["suffix_dedup"](spark, docs.where("doc_id in (1, 5, 6)"), folder).collect()}
    own = {r.doc_id: r.text.encode() for r in every if r.doc_id in (1, 5, 6)}
    for key, data in own.items():
        others = [v for k, v in own.items() if k != key]
        gone = {i for s in range(len(data) - 199) for i in range(s, s + 200) if any(data[s : s + 200] in o for o in others)}
        assert cut[str((key, "en"))] == bytes(b for i, b in enumerate(data) if i not in gone).decode() and (key == 1 or gone)
    hidden = {r.doc_id: r for r in stage["pii"](spark, docs, folder).collect()}
    assert "212-555-0123" not in hidden[7].text and "10.1.2.3" not in hidden[7].text and hidden[2].text is None and hidden[8].n_chars == 300_000
    pieces = stage["packing"](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in every}
    for name, run in corpus_pipeline.STAGES:
        got = run(spark, docs.where("false"), folder)
        assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_clashing_columns(spark):
    text = "".join(random.Random(2).choices("abcdefgh ", k=600))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "short")], "doc_id long, text string").withColumns({n: F.lit(n) for n in ("doc", "kid", "spans", "__doc", "key", "_key")})
    pruned = suffix.prune(docs)
    assert pruned.columns == docs.columns and {r.doc_id: (r.text, r.kid, r.spans) for r in pruned.collect()} == {1: ("", "kid", "spans"), 2: ("", "kid", "spans"), 3: ("short", "kid", "spans")}
    assert {(r.doc_id, r.key) for r in neardup.survivors(docs).collect()} == {(1, "key"), (3, "key")}
