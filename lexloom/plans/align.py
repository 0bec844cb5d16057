"""The alignment dataflow: blocking, cached decisions, a batched model, validation and application, stage by stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import alignment, inference
from ..functions.identifiers import query_id
from ..operators import batches, joins
from ..operators import decisions as rows_of
from ..schema import DECISION

DEFINITION = "struct<id:string,glosses:array<string>,synonyms:array<string>,tags:array<string>,topics:array<string>,examples:array<string>,sources:array<string>>"
QUERY = f"alignment_id string, lemma_id string, lemma string, pos string, sources array<{DEFINITION}>, targets array<{DEFINITION}>"
Model = Callable[[list[dict]], list[str | None]]
#: A worker asks the model once its queries hold so many characters, however few they are.
HELD_CHARS = 16_000_000
NONE = "array<string>"


def none():
    return F.array().cast(NONE)


def sense_definitions():
    """The senses of a lemma as definitions, with their sentences as examples."""
    return F.transform("senses", lambda s: F.struct(
        s["id"].alias("id"), s["glosses"].alias("glosses"), s["synonyms"].alias("synonyms"), s["tags"].alias("tags"), s["topics"].alias("topics"),
        F.transform(s["sentences"], lambda x: x["text"]).alias("examples"), none().alias("sources"))).cast(f"array<{DEFINITION}>")


def translation_queries(lemmas: DataFrame) -> DataFrame:
    """One query for each lemma with senses and translation tables."""
    targets = F.transform("translation_tables", lambda t: F.struct(t["id"].alias("id"), F.array(t["gloss"]).alias("glosses"), none().alias("synonyms"), none().alias("tags"), none().alias("topics"), none().alias("examples"), none().alias("sources")))
    asked = lemmas.where((F.size("senses") > 0) & (F.size("translation_tables") > 0))
    return asked.select(F.concat(F.lit("translations:"), "id").alias("alignment_id"), F.col("id").alias("lemma_id"), "lemma", "pos", sense_definitions().alias("sources"), targets.cast(f"array<{DEFINITION}>").alias("targets"))


def normal_form(col):
    """Forms compared in blocking: underscores as blanks, one blank between words, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.replace(col, F.lit("_"), F.lit(" ")), r"(?U)\s+", " ")))


def candidates(lemmas: DataFrame, synsets: DataFrame) -> DataFrame:
    """(lemma_id, synset_id): synsets with a member equal to the lemma or a variant, of the same part of speech."""
    as_noun = lambda c: F.when(c == "propn", "noun").otherwise(c)
    forms = lemmas.select(F.col("id").alias("lemma_id"), as_noun(F.col("pos")).alias("pos"), F.explode(F.array_distinct(F.transform(F.array_append("variants", F.col("lemma")), normal_form))).alias("form"))
    members = synsets.select(F.col("id").alias("synset_id"), as_noun(F.col("pos")).alias("pos"), F.explode(F.flatten(F.transform(F.map_values("sources"), lambda v: v["members"]))).alias("m"))
    return joins.block(forms, members.withColumn("form", normal_form(F.col("m"))), ["form", "pos"], "lemma_id", "synset_id")


def synset_queries(lemmas: DataFrame, synsets: DataFrame, stage: str | None = None, earlier: list[str] | None = None, links: DataFrame | None = None) -> DataFrame:
    """One query for each lemma with senses and candidates left.

    A stage sees synsets with its resource (any, for "remaining") and none of an earlier one; senses and synsets that
    `links` (lemma_id, source_id, target_id, relation) already holds as equivalent within the lemma take no part.
    """
    usable = joins.exclude_stages(synsets.withColumn("__r", F.map_keys("sources")), "__r", earlier or [])
    if stage not in (None, "remaining"):
        usable = usable.where(F.array_contains("__r", stage))
    shown = F.map_entries("sources") if stage in (None, "remaining") else F.filter(F.map_entries("sources"), lambda e: e["key"] == stage)
    flat = lambda name: F.array_distinct(F.flatten(F.transform(shown, lambda e: F.coalesce(e["value"][name], none()))))
    target = F.struct(F.col("id"), flat("glosses").alias("glosses"), flat("members").alias("synonyms"), none().alias("tags"), none().alias("topics"), flat("examples").alias("examples"), F.transform(shown, lambda e: e["key"]).alias("sources"))
    targets = usable.select(F.col("id").alias("synset_id"), target.cast(DEFINITION).alias("t"))
    pairs = candidates(lemmas, usable)
    senses = lemmas.select(F.col("id").alias("lemma_id"), "lemma", "pos", sense_definitions().alias("sources"))
    if links is not None:
        same = links.where(F.col("relation") == alignment.EXCLUSIVE)
        pairs = joins.without(pairs, same.select("lemma_id", F.col("target_id").alias("synset_id")), ["lemma_id", "synset_id"])
        done = same.groupBy("lemma_id").agg(F.collect_set("source_id").alias("done"))
        senses = senses.join(done, "lemma_id", "left").withColumn("sources", F.filter("sources", lambda s: ~F.array_contains(F.coalesce("done", none()), s["id"]))).drop("done")
    grouped = pairs.join(targets, "synset_id").groupBy("lemma_id").agg(F.array_sort(F.collect_list("t")).alias("targets"))
    prefix = query_id("synsets", "", stage)
    return senses.where(F.size("sources") > 0).join(grouped, "lemma_id").select(F.concat(F.lit(prefix), "lemma_id").alias("alignment_id"), "lemma_id", "lemma", "pos", "sources", "targets")


def decide(queries: DataFrame, cache: DataFrame, task: str, model: Model = alignment.stub_model, batch_size: int = 32_768) -> DataFrame:
    """TSV rows of all decisions: cached ones that hold, and the model's for the rest.

    The model is called in batches inside the workers, only for queries with something left to decide. A response that
    is missing or invalid leaves its query with the cached decisions; a result that is invalid as a whole does too.
    """
    batches.small_batches(queries.sparkSession)
    cached = rows_of.from_rows(cache.select(*rows_of.FIELDS)).groupBy("alignment_id").agg(F.collect_list(F.struct("source_id", "links")).alias("cached"))
    asked = queries.join(cached, "alignment_id", "left")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            open_ = [h for h in held if h[2] and h[3]]
            asked = [{"task": task, "lemma": h[0]["lemma"], "pos": h[0]["pos"], "sources": h[2], "targets": h[3]} for h in open_]
            answers = dict(zip([h[0]["alignment_id"] for h in open_], inference.answer(model, asked), strict=True))
            out = []
            for query, kept, sources, targets in held:
                result = dict(kept)
                if sources and not targets:  # nothing is left to link to: abstain
                    result |= {s["id"]: [] for s in sources}
                elif sources and (text := answers.get(query["alignment_id"])):
                    try:
                        made = {**kept, **alignment.parse_response(text, [s["id"] for s in sources])}
                        alignment.validate(task, made, [s["id"] for s in query["sources"]], [t["id"] for t in query["targets"]])
                        result = made
                    except alignment.InvalidResult:
                        pass
                for s in query["sources"]:
                    for x in result.get(s["id"]) or ([{"target_id": "", "relation": "", "reason": ""}] if s["id"] in result else []):
                        out.append((query["alignment_id"], s["id"], x["target_id"], x["relation"], x["reason"]))
            held.clear()
            columns = list(zip(*out, strict=True)) or [()] * len(rows_of.FIELDS)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], list(rows_of.FIELDS))

        for frame in frames:
            for q in frame.to_pylist():
                known = {c["source_id"]: [x for x in c["links"] if x is not None] for c in q["cached"] or ()}
                held.append((q, *alignment.remaining(task, known, q["sources"], q["targets"])))
                size += sum(len(text) for d in (*q["sources"], *q["targets"]) for name in ("glosses", "examples") for text in d[name] or ())
                if len(held) >= batch_size or size >= HELD_CHARS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return asked.mapInArrow(run, DECISION)


def replay(cache: DataFrame, queries: DataFrame, task: str) -> DataFrame:
    """(alignment_id, source_id, links) of stored rows, which must all belong to known queries.

    A row with an unknown query, source, target or relation, or without a reason, fails the job, and so does an exclusive
    link that is not one-to-one or a target that a source has twice. The counts are within a query, which has few rows.
    """
    known = queries.select("alignment_id", F.transform("sources", lambda s: s["id"]).alias("__s"), F.transform("targets", lambda t: t["id"]).alias("__t"))
    rows = cache.select(*rows_of.FIELDS).join(known, "alignment_id", "left")
    linked = F.col("target_id") != ""
    exclusive = linked & (F.lit(task in alignment.ONE_TO_ONE) | (F.col("relation") == alignment.EXCLUSIVE))
    within = lambda c: Window.partitionBy("alignment_id", c)
    rows = rows.withColumns({
        "__same": F.count_if(linked).over(Window.partitionBy("alignment_id", "source_id", "target_id")),
        "__by_source": F.count_if(exclusive).over(within("source_id")), "__by_target": F.count_if(exclusive).over(within("target_id")),
    })
    wrong = (
        F.when(F.col("__s").isNull(), "unknown query").when(~F.array_contains("__s", F.col("source_id")), "unknown source")
        .when(linked & ~F.array_contains("__t", F.col("target_id")), "unknown target")
        .when(linked & (~F.col("relation").isin(*alignment.RELATIONS[task]) | (F.trim("reason") == "")), "a link is not valid")
        .when(linked & (F.col("__same") > 1), "a target is linked twice")
        .when(exclusive & ((F.col("__by_source") > 1) | (F.col("__by_target") > 1)), "an exclusive link is not one-to-one")
    )
    told = F.concat(wrong, F.lit(": "), F.concat_ws(" ", *rows_of.FIELDS[:3]))
    return rows_of.from_rows(rows.withColumn("source_id", F.when(wrong.isNotNull(), F.raise_error(told)).otherwise(F.col("source_id"))))


def apply_translations(lemmas: DataFrame, queries: DataFrame, decided: DataFrame) -> DataFrame:
    """Lemmas whose senses carry their table, `table_of` by sense; the tables go once every sense of the lemma is decided."""
    links = decided.join(queries.select("alignment_id", "lemma_id", F.size("sources").alias("asked")), "alignment_id")
    per = links.groupBy("lemma_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("target_id") != "", F.struct("source_id", "target_id")))).alias("table_of"),
        (F.count_distinct("source_id") == F.first("asked")).alias("complete"),
    )
    empty = F.filter("translation_tables", lambda t: F.lit(False))
    joined = lemmas.join(per, lemmas.id == per.lemma_id, "left").drop("lemma_id")
    tables = F.transform("senses", lambda s: F.struct(s["id"].alias("id"), F.filter("translation_tables", lambda t: t["id"] == F.try_element_at("table_of", s["id"])).alias("t")))
    return joined.withColumn("aligned_tables", F.filter(tables, lambda x: F.coalesce(F.size(x["t"]), F.lit(0)) > 0)).withColumn(
        "translation_tables", F.when(F.coalesce("complete", F.lit(False)), empty).otherwise(F.col("translation_tables"))
    ).drop("table_of", "complete")


def apply_synsets(lemmas: DataFrame, queries: DataFrame, decided: DataFrame) -> DataFrame:
    """Lemmas with the synset links of their senses appended to `synsets`, an array of (sense_id, synset_id, relation)."""
    links = decided.where("target_id <> ''").join(queries.select("alignment_id", "lemma_id"), "alignment_id")
    kind = "struct<sense_id:string,synset_id:string,relation:string>"
    named = links.select(F.col("lemma_id").alias("id"), F.struct(F.col("source_id").alias("sense_id"), F.col("target_id").alias("synset_id"), "relation").alias("link"))
    before = F.col("synsets") if "synsets" in lemmas.columns else F.array().cast(f"array<{kind}>")
    columns = [c for c in lemmas.columns if c != "synsets"]
    return joins.apply_links(lemmas, named, "id", "link", kind).select(*columns, F.concat(before, "targets").alias("synsets"))


def align_stages(lemmas: DataFrame, synsets: DataFrame, stages: list[str], cache: DataFrame, work: str, model: Model = alignment.stub_model) -> tuple[DataFrame, DataFrame]:
    """Lemmas and decisions after all stages. A stage is written to the folder `work` before the next begins."""
    known = [r.k for r in synsets.select(F.explode(F.map_keys("sources")).alias("k")).distinct().collect()] if stages else []
    spark, earlier, every = lemmas.sparkSession, [], None
    for stage in alignment.select_stages(stages, known) or [None]:
        links = None
        if every is not None:
            owner = F.regexp_replace("alignment_id", "^synsets:(?:[^:]*:)?", "")
            links = every.where("target_id <> ''").select(owner.alias("lemma_id"), "source_id", "target_id", "relation")
        queries = synset_queries(lemmas, synsets, stage, earlier, links)
        path = f"{work}/{stage or 'all'}-{uuid.uuid4().hex}"
        decide(queries, cache, "synsets", model).write.parquet(f"{path}/decisions")
        decided = spark.read.schema(DECISION).parquet(f"{path}/decisions")
        merged = apply_synsets(lemmas, queries, decided)
        merged.write.parquet(f"{path}/lemmas")
        lemmas = spark.read.schema(merged.schema).parquet(f"{path}/lemmas")
        every = decided if every is None else every.unionByName(decided)
        earlier = [*earlier, stage] if stage else earlier
    return lemmas, every


def report(decided: DataFrame, task: str) -> dict:
    """Figures of a task: sources evaluated, aligned and unaligned, associations, and relations by frequency."""
    linked = F.col("target_id") != ""
    per = decided.groupBy("alignment_id", "source_id").agg(F.sum(linked.cast("long")).alias("n"))
    total = per.agg(F.count("*").alias("evaluated"), F.count_if(F.col("n") > 0).alias("aligned"), F.coalesce(F.sum("n"), F.lit(0)).alias("links")).first()
    relations = {r.relation: r.n for r in decided.where(linked).groupBy("relation").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "relation").collect()}
    return {"task": task, "senses": {"evaluated": total.evaluated, "aligned": total.aligned, "unaligned": total.evaluated - total.aligned}, "associations": int(total.links), "relations": relations}
