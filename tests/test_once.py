"""Texts are read once: no pass for each prefix, no Python for rows that need none, no scan where there is nothing to find."""

import json

import pytest
from pyspark.sql import functions as F

from lexloom.functions import formatting, mathematics, udfs
from lexloom.operators import filters
from lexloom.plans import collect
from lexloom.schema import RAW_ENTRY


def entries(spark, rows):
    return collect.usable(spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", RAW_ENTRY).alias("e")).select("e.*"))


def test_prefixes_are_one_pattern(spark):
    prefixes = ["plural of", "past", "a.b", "non-oxford"]
    glosses = ["plural of cat", " Plural  of\ncat", "pluralof", "plural ofs", "past", "past\n", "pastor", "a.b c", "axb c", "", "x past", "NON-Oxford x", "plural", None]
    assert "exists" not in str(filters.starts_with_any(F.col("g"), prefixes))
    found = [r[0] for r in spark.createDataFrame([(g,) for g in glosses], "g string").select(filters.starts_with_any(F.col("g"), prefixes)).collect()]
    plain = lambda g: None if g is None else any(" ".join(g.lower().split()) == p or " ".join(g.lower().split()).startswith(p + " ") for p in prefixes)
    assert found == [plain(g) for g in glosses]


def test_only_variants_go_through_python(spark, monkeypatch):
    def strict(gloss):
        assert gloss.startswith("Alternative"), gloss
        return gloss.split()[-1]

    monkeypatch.setattr(udfs, "referred", udfs.arrow("string")(udfs.nullable(strict)))
    rows = [{"word": "dawg", "pos": "noun", "lang_code": "en", "senses": [{"glosses": ["Alternative form of dog"]}]}, {"word": "dog", "pos": "noun", "lang_code": "en", "senses": [{"glosses": ["An animal of prey"]}]}]
    assert [(r.lemma_id, r.variants) for r in collect.variants(entries(spark, rows)).collect()] == [("dog.noun", ["dawg"])]


def test_texts_without_mathematics_stay():
    text = "é" * 3 + " plain"
    assert mathematics.latexize(text) is text
    block = lambda c: 0x2100 <= c < 0x2150 or 0x1D400 <= c < 0x1D800
    assert not [c for c in range(0x110000) if not block(c) and mathematics.letter(chr(c))]


@pytest.mark.parametrize("kind,text", [("invisible", "a​b"), ("mojibake", "Ã©"), ("footnote", "a ^([sic])"), ("citation", "<ref>x</ref>"), ("raised", "<sup>2</sup>"), ("lowered", "<sub>2</sub>"), ("tag", "<i>"), ("entity", "&amp;"), ("number", "#65;"), ("link", "[[a|b]]"), ("quotes", "''"), ("blanks", " \t")])
def test_needles_find_their_tokens(kind, text):
    scan = formatting._tokens(text, formatting.LETTERS + formatting.MARKUP)
    assert scan.search(text).lastgroup == kind
