"""Sources, collection, side tables, alignment, stream and commands on tiny inputs."""

import bz2
import io
import json
import tarfile

import pytest

from lexloom import cli
from lexloom.functions import alignment
from lexloom.operators import joins, merge
from lexloom.plans import align, collect, markdown, sidetables, sinks
from lexloom.schema import DECISION, RAW_ENTRY
from lexloom.sources import files, records, remote
from lexloom.streaming import decisions as stream

ENTRIES = [
    {"word": "dog", "pos": "noun", "lang_code": "en", "etymology_number": "1", "forms": [{"form": "dogs", "tags": ["plural"]}, {"form": "-"}],
     "senses": [{"glosses": ["An animal", "a [[pet]]"], "tags": ["countable"], "topics": ["zoology"], "wikidata": ["Q1", "Q1"],
                 "examples": [{"text": "The dogs bark.", "type": "example", "bold_text_offsets": [[4, 8]]}, {"text": "1999, A Book\nMy dog is old.", "type": "quotation"}],
                 "synonyms": [{"word": "hound"}, {"word": "dog"}]}, {"glosses": ["plural of cat"]}],
     "translations": [{"word": "chien m", "lang_code": "fr", "lang": "French", "sense": "an animal"}, {"word": "Hund", "lang_code": "de", "lang": "German", "sense": "an animal"}]},
    {"word": "dog", "pos": "noun", "lang_code": "en", "etymology_number": "1", "senses": [{"glosses": ["An animal", "a pet"], "tags": ["informal"], "wikidata": ["Q2", "Q1"]}],
     "translations": [{"word": "chienne f", "lang_code": "fr", "sense": "An animal."}]},
    {"word": "dawg", "pos": "noun", "lang_code": "en", "senses": [{"glosses": ["Alternative form of dog"], "tags": ["alt-of"], "alt_of": [{"word": "dog"}]}]},
    {"word": "Hund", "pos": "noun", "lang_code": "de", "senses": [{"glosses": ["x"]}]},
    {"word": "Rome", "pos": "name", "lang_code": "en", "senses": [{"glosses": ["a city"], "examples": 5}]},
]
PAGE = "==English==\n===Noun===\n# {{senseid|en|Q12}} an [[animal]]\n====Translations====\n{{trans-top|a new meaning}}\n* {{t|fr|chien|m}}\n{{trans-bottom}}\n{{trans-top|an animal}}\n{{t|it|cane}}\n{{trans-bottom}}\n{{trans-see|a pet|dawg}}\n<math>x^2</math>"
OTHER = "==English==\n===Noun===\n{{trans-top|A pet}}\n{{t|es|perro}}\n{{trans-bottom}}"


@pytest.fixture
def entries(spark, tmp_path):
    lines = ["noise", "", *map(json.dumps, ENTRIES), '{"word": "cut']
    (tmp_path / "entries.jsonl").write_text("\n".join(lines))
    return files.read_entries(spark, str(tmp_path / "entries.jsonl"))


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([("dog", PAGE), ("dawg", OTHER)], "title string, markup string")


@pytest.mark.parametrize("parts", [1, 7])
def test_collects_whatever_the_partitions(entries, parts):
    found = {r.id: r.asDict(True) for r in collect.collect(entries.repartition(parts)).collect()}
    assert set(found) == {"dog.noun", "Rome.propn"}
    dog = found["dog.noun"]
    assert dog["variants"] == ["dawg"]
    (sense,) = dog["senses"]
    assert sense["glosses"] == ["An animal.", "A pet."] and sense["tags"] == ["countable", "informal"] and sense["synonyms"] == ["hound"]
    assert sense["wikidata_ids"] == ["Q1", "Q1", "Q2"]
    assert [s["text"] for s in sense["sentences"]] == ["The dogs bark.", "My dog is old."]
    assert sense["sentences"][0]["word_offsets"] == [{"start": 4, "end": 8, "sources": ["lemmatizer", "bold"]}]
    (table,) = dog["translation_tables"]
    assert [(t["language"]["label"], t["words"]) for t in table["translations"]] == [("French", ["chien", "chienne"]), ("German", ["Hund"])]


def test_pos_filter_leaves_variants_and_years_drop_undated(entries):
    assert [r.id for r in collect.collect(entries, pos=["propn"]).collect()] == ["Rome.propn"]
    dog = next(r for r in collect.collect(entries, min_year=2000).collect() if r.id == "dog.noun")
    assert [s.text for s in dog.senses[0].sentences] == ["The dogs bark."]


def test_statistics_and_report(entries):
    found = collect.statistics(collect.collect(entries))
    assert found["totals"] == {"entries": 2, "senses": 2, "sentences": 2, "offsets": 2, "tags": 2, "topics": 1, "translation_languages": 2}
    assert found["wikidata_ids_per_sense"] == {"0": 1, "2": 1} and found["sentence_kinds"] == {"example": 1, "quotation": 1}
    text = markdown.render(found)
    assert [x[3:] for x in text.split("\n") if x.startswith("## ")] == ["Records", "Variants and synonyms", "Translations", "Sentences and quotations", "Word offsets", "Tags and topics"]
    assert markdown.share(1, 0) == "—" and markdown.escape("a|b") == "a\\|b"


def test_side_tables(entries, pages):
    found = {(r.lemma_id, r.gloss, r.code, r.label, r.word) for r in sidetables.off_page_translations(pages, entries).collect()}
    assert ("dog.noun", "A new meaning.", "fr", "French", "chien") in found  # not known, label from the entries
    assert ("dog.noun", "A pet.", "es", "", "perro") in found  # by pointer, under the pointer's gloss
    assert not any(r[4] == "cane" for r in found)  # the entry has that table
    (ids,) = sidetables.wikidata_ids(pages, entries).collect()
    assert ids.ids == ["Q12"]
    lemmas = collect.collect(entries, wikidata=sidetables.wikidata_ids(pages, entries), off_page=sidetables.off_page_translations(pages, entries))
    dog = next(r for r in lemmas.collect() if r.id == "dog.noun")
    assert [(s.glosses, s.wikidata_ids) for s in dog.senses] == [(["An animal."], ["Q12"]), (["An animal.", "A pet."], ["Q1", "Q1", "Q2"])]
    assert [t.gloss for t in dog.translation_tables] == ["An animal.", "A new meaning.", "A pet."] or {t.gloss for t in dog.translation_tables} == {"An animal.", "A new meaning.", "A pet."}


def test_merges_keep_order_and_inner_repeats(spark):
    rows = spark.createDataFrame([("a", 2, ["Q2", "Q2", "Q1"]), ("a", 1, ["Q1", "Q1"])], "k string, o int, v array<string>")
    from pyspark.sql import functions as F

    (found,) = rows.groupBy("k").agg(merge.in_order(F.col("v"), F.col("o")).alias("l")).select(merge.append_absent(F.col("l")).alias("v")).collect()
    assert found.v == ["Q1", "Q1", "Q2", "Q2"]


def test_ties_have_no_best(spark):
    rows = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.9), ("b", "x", 0.8), ("b", "y", 0.7), ("c", "x", 0.1)], "k string, v string, s double")
    assert [(r.k, r.v) for r in joins.best_without_ties(rows, "k", "v", "s", 0.7).collect()] == [("b", "x")]


@pytest.fixture
def synsets(spark, tmp_path):
    rows = [{"pos": "noun", "sources": {"wn": {"members": ["Dog"], "glosses": ["an animal kept as pet"]}}}, {"id": "s2", "pos": "noun", "sources": {"bn": {"members": ["dawg"], "glosses": ["a pet"]}}}]
    (tmp_path / "synsets.jsonl").write_text("\n".join(map(json.dumps, rows)))
    return records.read_synsets(spark, str(tmp_path / "synsets.jsonl"))


def test_stages_exclude_what_is_equivalent(spark, entries, synsets, tmp_path):
    empty = spark.createDataFrame([], DECISION)
    lemmas, decided = align.align_stages(collect.collect(entries), synsets, ["wn", "remaining"], empty, str(tmp_path / "work"))
    dog = next(r for r in lemmas.collect() if r.id == "dog.noun")
    assert [x.synset_id for x in dog.synsets] == ["synset-00000001"]
    assert {r.alignment_id for r in decided.collect()} == {"synsets:wn:dog.noun"}


def test_bad_synsets_fail(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text(json.dumps({"pos": "noun", "sources": {"remaining": {"members": ["x"], "glosses": ["y"]}}}))
    with pytest.raises(Exception, match="usable resource"):
        records.read_synsets(spark, str(tmp_path / "bad.jsonl")).collect()


def test_cache_is_reused_and_invalid_answers_leave_it(spark, entries, tmp_path):
    queries = align.translation_queries(collect.collect(entries))
    empty = spark.createDataFrame([], DECISION)
    first = align.decide(queries, empty, "translations").collect()
    assert [r.relation for r in first] == ["translation"]
    sinks.write_tsv((r.asDict() for r in first), tmp_path / "t.tsv", tuple(DECISION.replace(" string", "").split(", ")))
    again = align.decide(queries, records.read_decisions(spark, str(tmp_path / "t.tsv")), "translations", model=lambda requests: ["broken"] * len(requests))
    assert again.collect() == first
    assert align.decide(queries, empty, "translations", model=lambda requests: ["broken"] * len(requests)).count() == 0


@pytest.mark.parametrize("rows, said", [
    ([("q", "s", "t", "translation", "why")], None),
    ([("q", "s", "", "", "")], None),
    ([("p", "s", "", "", "")], "unknown query"),
    ([("q", "x", "", "", "")], "unknown source"),
    ([("q", "s", "x", "translation", "why")], "unknown target"),
    ([("q", "s", "t", "equivalent", "why")], "not valid"),
    ([("q", "s", "t", "translation", " ")], "not valid"),
    ([("q", "s", "t", "translation", "why"), ("q", "s", "t", "translation", "so")], "linked twice"),
    ([("q", "s", "t", "translation", "why"), ("q", "s2", "t", "translation", "so")], "one-to-one"),
])
def test_replay_refuses_what_is_unknown_or_invalid(spark, rows, said):
    one = lambda i: {"id": i, "glosses": [], "synonyms": [], "tags": [], "topics": [], "examples": [], "sources": []}
    queries = spark.createDataFrame([("q", "l", "l", "noun", [one("s"), one("s2")], [one("t"), one("u")])], align.QUERY)
    found = align.replay(spark.createDataFrame(rows, DECISION), queries, "translations")
    if said:
        with pytest.raises(Exception, match=said):
            found.collect()
    else:
        assert [(r.alignment_id, r.source_id, [x.target_id for x in r.links]) for r in found.collect()] == [("q", "s", [x[2] for x in rows if x[2]])]


def test_skipped_lines_are_counted(spark, entries, tmp_path):
    assert files.line_counts(spark, str(tmp_path / "entries.jsonl"), RAW_ENTRY).first() == (8, 5, 2, 1)


@pytest.mark.parametrize("text", ["a\tb\n", "alignment_id\tsource_id\ttarget_id\trelation\treason\nq\ts\tt\t\t\n", "alignment_id\tsource_id\ttarget_id\trelation\treason\nq\ts\t\t\t\np\ts\t\t\t\nq\ts2\t\t\t\n"])
def test_bad_decision_files_fail(spark, tmp_path, text):
    (tmp_path / "d.tsv").write_text(text)
    with pytest.raises(ValueError):
        records.read_decisions(spark, str(tmp_path / "d.tsv"))


def test_json_lines_drop_what_is_empty(spark, entries, tmp_path):
    found = collect.exported(collect.collect(entries))
    for suffix in ("", ".gz", ".bz2", ".zst"):
        path = sinks.writer_for(f"x.jsonl{suffix}")(found, tmp_path / f"x.jsonl{suffix}", "ord")
        with files.open_any(path) as file:
            rows = [json.loads(x) for x in io.TextIOWrapper(file, "utf-8")]
        assert [r["id"] for r in rows] == ["dog.noun", "Rome.propn"] and "variants" not in rows[1] and "synonyms" not in rows[1]["senses"][0]
    back = records.read_lemmas(spark, str(tmp_path / "x.jsonl"))
    assert next(r for r in back.collect() if r.id == "dog.noun").senses[0].sentences[0].word_offsets[0].start == 4
    with pytest.raises(ValueError):
        sinks.writer_for("x.csv")


def test_legacy_tables(spark, tmp_path):
    row = {"id": "a.noun", "lemma": "a", "pos": "noun", "translation_tables": [{"id": "t", "gloss": "G.", "translations": {"fr": ["b", "a"]}, "languages": {"fr": "French"}}]}
    (tmp_path / "l.jsonl").write_text(json.dumps(row))
    (found,) = records.read_lemmas(spark, str(tmp_path / "l.jsonl")).collect()
    assert found.translation_tables[0].translations[0].language.label == "French" and found.translation_tables[0].translations[0].words == ["a", "b"]


def test_publishing_is_all_or_nothing(tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "a").write_text("old")
    with pytest.raises(RuntimeError), sinks.published(tmp_path / "out") as staging:
        (staging / "a").write_text("new")
        raise RuntimeError
    assert (tmp_path / "out" / "a").read_text() == "old" and len(list(tmp_path.iterdir())) == 1
    with sinks.published(tmp_path / "out") as staging:
        (staging / "a").write_text("new")
    assert (tmp_path / "out" / "a").read_text() == "new"


def test_archives(tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "senses.jsonl").write_text("1\n2\n")
    for suffix in (".gz", ".bz2", ".zst"):
        out = files.publish_archive(tmp_path / "d", tmp_path / f"d.tar{suffix}")
        assert [x.strip() for x in files.archive_lines(out, "senses.jsonl")] == ["1", "2"]
    with pytest.raises(FileNotFoundError):
        list(files.archive_lines(out, "none"))
    assert tarfile.is_tarfile(tmp_path / "d.tar.gz")


def test_dates(tmp_path):
    status = {"20260101": '{"jobs": {"articlesdumprecombine": {"status": "done"}}}', "20260201": '{"jobs": {"articlesdumprecombine": {"status": "waiting"}}}', "20260301": "oops"}
    index = "".join(f'<a href="{d}/">' for d in status)
    assert remote.latest_date(index, status.get) == "20260101"
    with pytest.raises(LookupError):
        remote.latest_date("", status.get)
    (tmp_path / "20260101").mkdir()
    assert remote.fetched_date(tmp_path) == "20260101"
    with pytest.raises(FileNotFoundError):
        remote.fetched_date(tmp_path, "20250101")


def test_stream_decides_each_lemma_once(spark, entries, tmp_path):
    sinks.write_json_lines(collect.collect(entries), tmp_path / "in" / "a.jsonl", "ord") if (tmp_path / "in").mkdir() is None else None
    for _ in range(2):
        stream.align_stream(stream.lemma_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    assert stream.decided(spark, str(tmp_path / "out")).count() == 1


def test_commands_end_to_end(spark, tmp_path):
    folder = tmp_path / "cache" / "20260101"
    folder.mkdir(parents=True)
    (folder / "entries.jsonl").write_text("\n".join(map(json.dumps, ENTRIES)))
    xml = f'<mediawiki xmlns="http://x/"><page><title>dog</title><ns>0</ns><revision><text xml:space="preserve">{PAGE.replace("<", "&lt;")}</text></revision></page><page><title>T</title><ns>1</ns><revision><text>x</text></revision></page></mediawiki>'
    (folder / "pages.xml.bz2").write_bytes(bz2.compress(xml.encode()))
    common = ["--cache-dir", str(tmp_path / "cache")]
    assert cli.main(["parse", *common]) == 0
    assert cli.main(["collect", *common, "--output-dir", str(tmp_path / "c")]) == 0
    assert cli.main(["align", str(tmp_path / "c" / "senses.jsonl"), "--output-dir", str(tmp_path / "a")]) == 0
    assert {p.name for p in (tmp_path / "a").iterdir()} == {"manifest.json", "reports", "senses.jsonl", "translations.tsv"}
    assert json.loads((tmp_path / "a" / "reports" / "translations.json").read_text())["senses"]["evaluated"] == 2
    with pytest.raises(SystemExit):
        cli.main(["align", str(tmp_path / "none"), "--output-dir", str(tmp_path / "a")])
    assert cli.option("a=1") == ("a", 1) and cli.option("a=x") == ("a", "x")
    assert alignment.response_schema("translations", ["s"], ["t"])["properties"]["s"]["anyOf"][1]["maxItems"] == 1
