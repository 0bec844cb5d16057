"""The parse dataflow: one scan of dump pages into three side tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import glosses, identifiers, matching, udfs
from ..operators import filters, joins, merge
from .collect import lemma_id, usable


def known_glosses(entries: DataFrame) -> DataFrame:
    """(lemma_id, gloss_key) of tables that parsed entries have completely."""
    rows = usable(entries).select("lemma_id", F.explode("translations").alias("t"))
    named = rows.select("lemma_id", udfs.heading(F.coalesce("t.sense", F.lit(""))).alias("g"), (F.coalesce(F.trim("t.word"), F.lit("")) != "").alias("complete")).where("g <> ''")
    found = merge.known_keys(named.withColumn("gloss_key", udfs.heading_key("g")), "lemma_id", "gloss_key", F.col("complete"))
    return found.select("lemma_id", F.explode("known").alias("gloss_key"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Words and pointers of pages: (title, lemma, lemma_id, sub, kind, pos, gloss, gloss_key, code, word)."""
    likely = pages.where(filters.page_may_hold(F.col("markup"), "trans-top", "trans-see"))
    found = likely.select("title", F.explode(udfs.page_translations("title", "markup")).alias("r"))
    sub = F.endswith("title", F.lit("/translations"))
    rows = found.select(
        "title", F.when(sub, F.expr("substring(title, 1, length(title) - 13)")).otherwise(F.col("title")).alias("lemma"), sub.alias("sub"),
        "r.kind", "r.pos", udfs.heading("r.gloss").alias("gloss"), F.col("r.language").alias("code"), "r.word",
    ).where("gloss <> ''")
    return rows.withColumns({"lemma_id": lemma_id(F.col("lemma"), F.col("pos")), "gloss_key": udfs.heading_key("gloss")})


def off_page_translations(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(lemma_id, gloss, code, label, word): tables that stand elsewhere, and those that pointers name, under the pointer's gloss."""
    rows = page_rows(pages)
    words = rows.where("kind = 'word'")
    missing = joins.without(words, known_glosses(entries), ["lemma_id", "gloss_key"], exempt=F.col("sub"))
    own = missing.select("lemma_id", "gloss", "code", F.lit("").alias("label"), "word")
    pointers = rows.where("kind = 'pointer'").select(
        F.col("lemma_id").alias("entry_id"), "gloss", "gloss_key", lemma_id(F.col("word"), F.col("pos")).alias("target_id"))
    parsed = usable(entries).select("lemma_id", F.explode("translations").alias("t")).select(
        F.col("lemma_id").alias("entry_id"), udfs.heading_key(udfs.heading(F.coalesce("t.sense", F.lit("")))).alias("gloss_key"),
        F.col("t.lang_code").alias("code"), F.coalesce("t.lang", F.lit("")).alias("label"), "t.word")
    paged = words.select(F.col("lemma_id").alias("entry_id"), "gloss_key", "code", F.lit("").alias("label"), "word")
    resolved = joins.resolve_pointers(pointers, parsed.unionByName(paged)).select(F.col("entry_id").alias("lemma_id"), "gloss", "code", "label", "word")
    return joins.fill_label(own.unionByName(resolved).distinct(), labels(entries), "code", "label").select("lemma_id", "gloss", "code", F.coalesce("label", F.lit("")).alias("label"), "word")


def labels(entries: DataFrame) -> DataFrame:
    """(code, label): the first label seen of each language."""
    rows = usable(entries).select("ord", F.posexplode("translations").alias("at", "t")).where("t.lang <> '' and t.lang_code is not null")
    return rows.groupBy(F.col("t.lang_code").alias("code")).agg(F.min_by("t.lang", F.struct("ord", "at")).alias("label"))


def markup_index(pages: DataFrame) -> DataFrame:
    """(title, formulas) of pages with formulas."""
    likely = pages.where(filters.page_may_hold(F.col("markup"), "<math"))
    return likely.select("title", udfs.page_formulas("markup").alias("formulas")).where(F.size("formulas") > 0)


def definitions(pages: DataFrame) -> DataFrame:
    """(lemma, pos, etymology, depth, text, ids): definition lines with Wikidata ids."""
    likely = pages.where(filters.page_may_hold(F.col("markup"), "senseid"))
    return likely.select(F.col("title").alias("lemma"), F.explode(udfs.wikidata_definitions("markup")).alias("d")).select("lemma", "d.*")


def _match(key: tuple, senses: pd.DataFrame, defs: pd.DataFrame) -> pd.DataFrame:
    """Definitions of one entry to its senses: those of the same etymology, else of the only other one that fits."""
    pools: dict[str, list[dict]] = {}
    for g, i, e in zip(senses.glosses, senses.ids, senses.etymology, strict=True):
        pools.setdefault(e, []).append({"glosses": list(g), "ids": list(i)})
    out = []
    for d in defs.itertuples():
        names = [d.etymology] if d.etymology in pools else []
        fits = [(e, f) for e in names if (f := matching.best(d.text, d.depth, list(d.ids), pools[e]))]
        if not fits and not d.etymology:
            fits = [(e, f) for e in pools if e and (f := matching.best(d.text, d.depth, list(d.ids), pools[e]))]
        if len(fits) == 1:
            (etymology, (at, depth)) = fits[0]
            if chain := glosses.clean_chain(pools[etymology][at]["glosses"][:depth]):
                out.append((identifiers.sense_id(key[0], key[1], etymology, chain), list(d.ids)))
    return pd.DataFrame(out, columns=["sense_id", "ids"])


def wikidata_ids(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(sense_id, ids): ids of definition lines, matched to senses by ids and words. A group is one entry's page."""
    senses = usable(entries).select("lemma", F.col("tag").alias("pos"), F.coalesce("etymology_number", F.lit("")).alias("etymology"), F.explode("senses").alias("s")).select(
        "lemma", "pos", "etymology", F.coalesce("s.glosses", F.array().cast("array<string>")).alias("glosses"), F.coalesce("s.wikidata", F.array().cast("array<string>")).alias("ids")
    )
    found = definitions(pages)
    both = senses.join(found.select("lemma", "pos").distinct(), ["lemma", "pos"], "left_semi")
    matched = both.groupBy("lemma", "pos").cogroup(found.groupBy("lemma", "pos")).applyInPandas(_match, "sense_id string, ids array<string>")
    return matched.groupBy("sense_id").agg(F.array_distinct(F.flatten(F.sort_array(F.collect_list("ids")))).alias("ids"))


def side_tables(pages: DataFrame, entries: DataFrame) -> Iterator[tuple[str, DataFrame]]:
    """All side tables by name; pages should be a written table, for it is read once for each."""
    yield "off_page_translations", off_page_translations(pages, entries)
    yield "wikidata_ids", wikidata_ids(pages, entries)
    yield "markup_index", markup_index(pages)
