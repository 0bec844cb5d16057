"""The collection dataflow: raw entries to merged lemmas, and the statistics of the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import glosses, offsets, udfs
from ..operators import batches, filters, joins, merge, reports
from ..schema import SENSE, SENTENCE, TABLE

IN_LANGUAGE = "en"
#: A sense comes after those of its ancestors that stand at the same place.
LEAF = 1_000_000


def lemma_id(lemma: Column, pos: Column) -> Column:
    return F.concat(F.replace(lemma, F.lit(" "), F.lit("_")), F.lit("."), pos)


def usable(entries: DataFrame, language: str = IN_LANGUAGE) -> DataFrame:
    """Entries of a language with a headword and a part of speech that is kept; lemma, tag and lemma_id are added."""
    kept = filters.has_headword(filters.in_language(entries, language))
    named = kept.withColumns({"lemma": filters.unicode_trim(F.col("word")), "tag": filters.map_pos(F.col("pos"))}).where("tag is not null")
    return named.withColumn("lemma_id", lemma_id(F.col("lemma"), F.col("tag")))


def variants(entries: DataFrame) -> DataFrame:
    """(lemma_id, variants) gathered over all entries, whatever parts of speech are asked for later."""
    senses = entries.select("lemma", "tag", F.explode("senses").alias("s"))
    targets = F.when(F.arrays_overlap("s.tags", F.array(F.lit("alt-of"))), F.transform("s.alt_of", lambda a: a["word"]))
    described = F.exists("s.glosses", lambda g: filters.starts_with_any(g, _variant_prefixes()))
    # Only glosses that describe a variant go through Python; a UDF under a condition would read all of them.
    naming = senses.select("lemma", "tag", targets.alias("targets"), F.when(targets.isNull() & described, F.element_at("s.glosses", -1)).alias("gloss")).where("targets is not null or gloss is not null")
    named = naming.select("lemma", "tag", F.explode(F.coalesce("targets", F.array(udfs.referred("gloss")))).alias("target")).where("target is not null and target <> ''")
    own = named.select(F.col("lemma").alias("variant"), F.col("target").alias("lemma"), lemma_id(F.col("target"), F.col("tag")).alias("lemma_id"))
    return merge.gather_variants(own, "lemma", "variant", by="lemma_id")


def _variant_prefixes() -> list[str]:
    return [p for line in glosses.VARIANT_PREFIXES.split("\n") for p in line.split("|") if p]


def translation_tables(entries: DataFrame, off_page: DataFrame | None = None) -> DataFrame:
    """(lemma_id, translation_tables): words by gloss and language over all entries of a lemma, in first-seen order.

    off_page: (lemma_id, gloss, code, label, word) rows of other pages, which come after an entry's own.
    """
    rows = entries.select("lemma_id", "lemma", "tag", "ord", F.posexplode("translations").alias("at", "t")).select(
        "lemma_id", "lemma", "tag", F.struct(F.lit(0).alias("late"), "ord.file", "ord.block", "ord.place", "at").alias("ord"),
        F.coalesce("t.sense", F.lit("")).alias("gloss"), F.col("t.lang_code").alias("code"), F.coalesce("t.lang", F.lit("")).alias("label"), F.col("t.word").alias("word"),
    )
    if off_page is not None:
        last = F.struct(F.lit(1).alias("late"), F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("place"), F.lit(0).alias("at"))
        names = entries.select("lemma_id", "lemma", "tag").distinct()
        rows = rows.unionByName(off_page.withColumn("ord", last).join(names, "lemma_id").select(rows.columns))
    cleaned = rows.withColumns({"gloss": udfs.heading("gloss"), "c": udfs.clean_translation("code", "word")}).where("gloss <> '' and c is not null")
    words = cleaned.select("lemma_id", "lemma", "tag", "ord", "gloss", F.col("c.code").alias("code"), "label", F.explode("c.words").alias("word"))
    by_language = merge.merge_tables(words, ["lemma_id", "lemma", "tag", "gloss", "code"], "word", "label", "ord").withColumn("label", F.coalesce("label", F.lit("")))
    shaped = F.struct(F.struct("code", "label").alias("language"), "words")
    by_gloss = by_language.groupBy("lemma_id", "lemma", "tag", "gloss").agg(F.min("first").alias("ord"), merge.in_order(shaped, F.col("first")).alias("l"))
    table = F.struct(udfs.table_id("lemma", "tag", "gloss").alias("id"), "gloss", F.col("l").alias("translations"))
    return by_gloss.withColumn("table", table).groupBy("lemma_id").agg(merge.in_order(F.col("table"), F.col("ord")).cast(f"array<{TABLE}>").alias("translation_tables"))


def merge_senses(senses: DataFrame) -> DataFrame:
    """(lemma_id, s, o): senses of the same id as one; lists grow by what they lack, sentences are concatenated."""
    grouped = senses.groupBy("lemma_id", F.col("s.id").alias("sense_id")).agg(F.array_sort(F.collect_list(F.struct("o", "s"))).alias("all"))
    pick = lambda name: F.transform("all", lambda x: x["s"][name])
    first = lambda name: F.get("all", F.lit(0))["s"][name].alias(name)
    grown = lambda name: merge.append_absent(pick(name)).alias(name)
    made = F.struct(first("id"), first("glosses"), first("etymology"), grown("synonyms"), grown("tags"), grown("topics"), F.flatten(pick("sentences")).alias("sentences"), grown("wikidata_ids"))
    return grouped.select("lemma_id", F.get("all", F.lit(0))["o"].alias("o"), made.alias("s"))


def reused(df: DataFrame) -> DataFrame:
    """A frame that several branches read, kept: as Parquet in the shared checkpoint folder if there is one, else by executors."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    path = f"{folder.rstrip('/')}/lexloom/reused-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ancestors(entry: DataFrame, wikidata: DataFrame) -> DataFrame:
    """(lemma_id, o, s): a sense without evidence for each inner level that has ids, before the first sense below it."""
    chains = entry.select("lemma_id", "lemma", "tag", "ord", F.posexplode("built").alias("at", "s")).where(F.size("s.glosses") > 1)
    levels = chains.select("lemma_id", "lemma", "tag", "ord", "at", F.col("s.etymology").alias("etymology"), "s.glosses", F.explode(F.sequence(F.lit(1), F.size("s.glosses") - 1)).alias("depth"))
    named = levels.withColumn("glosses", F.slice("glosses", F.lit(1), F.col("depth"))).withColumn("sense_id", udfs.sense_id("lemma", "tag", "etymology", "glosses"))
    own = entry.select("lemma_id", "ord", F.explode("built").alias("b")).select("lemma_id", "ord", F.col("b.id").alias("sense_id"))
    found = named.join(wikidata.select("sense_id"), "sense_id", "left_semi").join(own, ["lemma_id", "ord", "sense_id"], "left_anti")
    first = merge.first_seen(found, ["lemma_id", "ord", "sense_id"], "at")
    none = F.array().cast("array<string>")
    made = F.struct(
        F.col("sense_id").alias("id"), "glosses", "etymology", none.alias("synonyms"), none.alias("tags"), none.alias("topics"),
        F.array().cast(f"array<{SENTENCE}>").alias("sentences"), none.alias("wikidata_ids"))
    return first.select("lemma_id", F.struct("ord", "at", "depth").alias("o"), made.cast(SENSE).alias("s"))


def collect(
    entries: DataFrame, pos: list[str] | None = None, min_year: int | None = None, max_year: int | None = None, language: str = IN_LANGUAGE,
    markup: DataFrame | None = None, wikidata: DataFrame | None = None, off_page: DataFrame | None = None,
    locate: Callable[[str, list[str]], list[tuple[int, int]]] = offsets.match_forms,
) -> DataFrame:
    """Merged lemmas, (ord, id, lemma, pos, variants, senses, translation_tables), in first-seen order of `ord`.

    markup: (title, formulas); wikidata: (sense_id, ids); off_page: see translation_tables().
    """
    batches.small_batches(entries.sparkSession)
    every = usable(entries, language)
    wanted = every.where(F.col("tag").isin(*pos)) if pos else every
    with_markup = wanted.join(markup.select(F.col("title").alias("lemma"), "formulas"), "lemma", "left") if markup is not None else wanted.withColumn("formulas", F.lit(None).cast("array<struct<rendered:string,source:string,prefix:string,suffix:string>>"))
    built = with_markup.withColumn("built", udfs.builder(min_year, max_year)("lemma", "tag", "etymology_number", "senses", "formulas")).where(F.size("built") > 0)
    forms = filters.service_forms(F.coalesce("forms", F.array().cast("array<struct<form:string,tags:array<string>>>")), F.col("lemma"))
    # Four branches read the built entries; without this each would clean all texts again.
    entry = reused(built.select("lemma_id", "lemma", "tag", "ord", "built", forms.alias("own_forms"), "translations"))
    heads = entry.groupBy("lemma_id").agg(F.min("ord").alias("ord"), F.first("lemma").alias("lemma"), F.first("tag").alias("pos"), F.array_distinct(F.flatten(F.collect_list("own_forms"))).alias("forms"))
    none = F.array().cast("array<string>")
    heads = joins.look_up(heads, variants(every), ["lemma_id"], {"variants": none})
    # Texts are dealt out by lemma once; merging, nesting and the join with heads find them there.
    dealt = entry.select("lemma_id", "ord", F.posexplode("built").alias("at", "s")).repartition("lemma_id")
    senses = dealt.select("lemma_id", F.struct("ord", "at", F.lit(LEAF).alias("depth")).alias("o"), "s")
    if wikidata is not None:
        senses = senses.unionByName(ancestors(entry, wikidata))
    merged = merge_senses(senses)
    if wikidata is not None:
        known = wikidata.select("sense_id", F.col("ids").alias("more"))
        joined = merged.withColumn("sense_id", F.col("s.id")).join(known, "sense_id", "left")
        merged = joined.withColumn("s", F.col("s").withField("wikidata_ids", merge.append_absent(F.array("s.wikidata_ids", F.coalesce("more", F.array().cast("array<string>")))))).select("lemma_id", "o", "s")
    nested = merged.groupBy("lemma_id").agg(merge.in_order(F.col("s"), F.col("o")).cast(f"array<{SENSE}>").alias("senses"))
    lemmas = joins.look_up(heads.join(nested, "lemma_id"), translation_tables(entry, off_page), ["lemma_id"], {"translation_tables": F.array().cast(f"array<{TABLE}>")})
    # Locating is Python, behind which Spark knows no partitioning, so it comes after all that needs one.
    located = udfs.locator(locate)("senses", F.array_union("forms", "variants"))
    return lemmas.select("ord", F.col("lemma_id").alias("id"), "lemma", "pos", "variants", located.alias("senses"), "translation_tables")


def exported(lemmas: DataFrame) -> DataFrame:
    """Lemmas in the shape of the JSON lines: a range is offset [start, end] with its sources."""
    offset = lambda o: F.struct(F.array(o["start"], o["end"]).alias("offset"), o["sources"].alias("sources"))
    sentence = lambda x: F.struct(x["text"].alias("text"), F.transform(x["word_offsets"], offset).alias("word_offsets"), x["reference"].alias("reference"), x["year"].alias("year"))
    return lemmas.withColumn("senses", F.transform("senses", lambda s: s.withField("sentences", F.transform(s["sentences"], sentence))))


def counts(df: DataFrame, key: Column) -> dict:
    """A histogram, by native key."""
    rows = reports.histogram(df, key, "k").where("k is not null").orderBy("k").collect()
    return {str(r.k): r.n for r in rows}


def statistics(lemmas: DataFrame) -> dict:
    """The report's counters. Each is one aggregate over one grain; what is collected is bounded by distinct labels."""
    senses = lemmas.select("lemma", F.explode("senses").alias("s"))
    # Checking is Python and nine figures read it, so it is done once.
    sentences = reused(senses.select("lemma", F.explode("s.sentences").alias("x")).withColumn("c", udfs.check_sentence("x.text", "x.word_offsets", "lemma")).select("x.year", "x.reference", "x.word_offsets", "c").select(F.struct("year", "reference", "word_offsets").alias("x"), "c"))
    tables = lemmas.select(F.explode("translation_tables").alias("t"))
    words = tables.select(F.explode("t.translations").alias("l"))
    quoted = F.col("x.reference").isNotNull()
    one = lambda df, e: int(df.agg(e.alias("v")).first().v or 0)
    found = {
        "entries": counts(lemmas, F.col("pos")), "senses_per_entry": counts(lemmas, F.size("senses")),
        "senses": counts(lemmas.select("pos", F.explode("senses")), F.col("pos")), "gloss_depths": counts(senses, F.size("s.glosses")),
        "unattested_senses": one(senses, F.count_if(F.size("s.sentences") == 0)),
        "tags": counts(senses.select(F.explode("s.tags").alias("v")), F.col("v")), "topics": counts(senses.select(F.explode("s.topics").alias("v")), F.col("v")),
        "wikidata_ids_per_sense": counts(senses, F.size(F.array_distinct("s.wikidata_ids"))),
        "synonym_senses": one(senses, F.count_if(F.size("s.synonyms") > 0)), "synonyms": one(senses, F.sum(F.size("s.synonyms"))),
        "variant_entries": one(lemmas, F.count_if(F.size("variants") > 0)), "variants": one(lemmas, F.sum(F.size("variants"))),
        "translated_entries": one(lemmas, F.count_if(F.size("translation_tables") > 0)), "translation_tables": one(lemmas, F.sum(F.size("translation_tables"))),
        "translations": one(words, F.sum(F.size("l.words"))),
        "translation_languages": {r.k: r.n for r in words.groupBy(F.col("l.language.code").alias("k")).agg(F.sum(F.size("l.words")).alias("n")).orderBy("k").collect()},
        "sentences": counts(lemmas.select("pos", F.explode(F.flatten(F.transform("senses", lambda s: s["sentences"])))), F.col("pos")),
        "sentence_kinds": counts(sentences, F.when(quoted, "quotation").otherwise("example")),
        "quotation_years": counts(sentences.where(quoted), F.col("x.year")), "undated_quotations": one(sentences, F.count_if(quoted & F.col("x.year").isNull())),
        "offsets_per_sentence": counts(sentences, F.col("c.offsets")), "unlocated_sentences": one(sentences, F.count_if(~F.col("c.located"))),
        "unlocated_headwords": counts(sentences.where("not c.located"), F.col("c.shape")), "literal_misses": one(sentences, F.count_if(~F.col("c.located") & F.col("c.literal"))),
        "source_relations": counts(sentences.where("c.located"), F.col("c.relation")), "offsets": one(sentences, F.sum("c.offsets")),
        "offset_sources": counts(sentences.select(F.explode("x.word_offsets").alias("o")), F.array_join(F.sort_array("o.sources"), "+")),
        "offset_violations": counts(sentences.select(F.explode("c.violations").alias("v")), F.col("v")), "different_surfaces": one(sentences, F.sum("c.surfaces")),
    }
    middle = lambda df, key: reports.median_of(reports.histogram(df, key, "k").where("k is not null"), "k", "n").first().median
    found["medians"] = {"senses_per_entry": middle(lemmas, F.size("senses")), "gloss_depths": middle(senses, F.size("s.glosses")), "offsets_per_sentence": middle(sentences, F.col("c.offsets")), "quotation_years": middle(sentences.where(quoted), F.col("x.year"))}
    total = lambda name: sum(found[name].values())
    found["totals"] = {"entries": total("entries"), "senses": total("senses"), "sentences": total("sentences"), "offsets": found["offsets"], "tags": len(found["tags"]), "topics": len(found["topics"]), "translation_languages": len(found["translation_languages"])}
    return found
