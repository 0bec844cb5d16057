"""Typed scans: collected lemmas, synsets, decisions, prompts and side tables."""

from __future__ import annotations

import json
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decisions import FIELDS
from ..operators.ordering import line_numbers, split_runs
from ..schema import DECISION, LEMMA, SPAN, SYNSET, TABLE
from .files import json_lines, numbered_lines

LEGACY = "array<struct<id:string,gloss:string,translations:map<string,array<string>>,languages:map<string,string>>>"


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """Collected lemmas in file order; both layouts of translations are read."""
    stored = LEMMA.replace(f"translation_tables array<{TABLE}>", "translation_tables string").replace(SPAN, "struct<offset:array<int>,sources:array<string>>")
    raw = json_lines(spark, path, stored)
    old = F.from_json("translation_tables", LEGACY)
    converted = F.transform(old, lambda t: F.struct(
        t["id"].alias("id"), t["gloss"].alias("gloss"),
        F.transform(F.map_entries(t["translations"]), lambda e: F.struct(
            F.struct(e["key"].alias("code"), F.coalesce(F.try_element_at(t["languages"], e["key"]), F.lit("")).alias("label")).alias("language"),
            F.sort_array(e["value"]).alias("words"))).alias("translations")))
    tables = F.when(F.col("translation_tables").rlike(r'"translations"\s*:\s*\{'), converted).otherwise(F.from_json("translation_tables", f"array<{TABLE}>"))
    empty = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    kinds = dict(spark.createDataFrame([], LEMMA).dtypes)
    span = lambda o: F.struct(F.get(o["offset"], F.lit(0)).alias("start"), F.get(o["offset"], F.lit(1)).alias("end"), o["sources"].alias("sources"))
    sentence = lambda x: F.struct(x["text"].alias("text"), F.transform(x["word_offsets"], span).alias("word_offsets"), x["reference"].alias("reference"), x["year"].alias("year"))
    text = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    sense = lambda s: F.struct(
        s["id"].alias("id"), text(s["glosses"]).alias("glosses"), F.coalesce(s["etymology"], F.lit("")).alias("etymology"), text(s["synonyms"]).alias("synonyms"), text(s["tags"]).alias("tags"),
        text(s["topics"]).alias("topics"), F.coalesce(F.transform(s["sentences"], sentence), F.filter(F.transform(F.array(F.lit(0)), lambda _: F.struct(F.lit("").alias("text"), F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.array(F.lit("")).alias("sources"))).alias("word_offsets"), F.lit("").alias("reference"), F.lit(0).alias("year"))), lambda _: F.lit(False))).alias("sentences"), text(s["wikidata_ids"]).alias("wikidata_ids"))
    raw = raw.withColumn("senses", F.transform("senses", sense).cast(kinds["senses"]))
    return raw.withColumn("translation_tables", F.coalesce(tables, F.array().cast(kinds["translation_tables"]))).withColumns({c: empty(c, kinds[c]) for c in ("variants", "senses")})


def read_synsets(spark: SparkSession, path: str) -> DataFrame:
    """Synsets; a row without resources, members or glosses, or with a reserved resource name, fails the job."""
    rows = json_lines(spark, path, SYNSET)
    bad = (
        F.coalesce(F.size(F.map_keys("sources")) < 1, F.lit(True)) | F.exists(F.map_keys("sources"), lambda k: k.isin("", "remaining"))
        | F.exists(F.map_values("sources"), lambda v: (F.coalesce(F.size(v["members"]), F.lit(0)) < 1) | (F.coalesce(F.size(v["glosses"]), F.lit(0)) < 1))
    )
    checked = rows.withColumn("pos", F.when(bad, F.raise_error(F.lit("a synset has no usable resource"))).otherwise(F.col("pos")))
    numbers = line_numbers(numbered_lines(spark, path).select("ord.place", "ord"), "place", "ord")
    named = checked.where("id is not null")
    unnamed = checked.where("id is null").withColumn("place", F.col("ord.place")).join(numbers, "place")
    return named.unionByName(unnamed.withColumn("id", F.format_string("synset-%08d", "line")).drop("line", "place")).drop("ord")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decision rows in file order. A wrong header, partly filled rows or split groups fail; no file gives no rows."""
    if not Path(path).is_file():
        return spark.createDataFrame([], f"ord long, {DECISION}")
    with open(path, encoding="utf-8") as file:
        if tuple(file.readline().rstrip("\r\n").split("\t")) != FIELDS:
            raise ValueError(f"{path} has another header")
    rows = spark.read.csv(path, schema=DECISION, sep="\t", header=True, quote='"', escape='"', multiLine=True, nullValue="\0", emptyValue="")
    rows = rows.na.fill("").withColumn("ord", F.monotonically_increasing_id())
    filled = sum((F.col(c) != "").cast("int") for c in FIELDS[2:4])
    if rows.where((filled == 1) | (F.col("alignment_id") == "") | (F.col("source_id") == "")).limit(1).count():
        raise ValueError(f"{path} has a partly filled row")
    both = rows.withColumn("pair", F.concat_ws("\t", "alignment_id", "source_id"))
    if split_runs(rows, "alignment_id", "ord").limit(1).count() or split_runs(both, "pair", "ord").limit(1).count():
        raise ValueError(f"{path} has a group whose rows don't stand together")
    return rows.select("ord", *FIELDS)


def parse_query(line: str) -> dict:
    """A query record {alignment_id, task, lemma, pos, sources, targets}; definitions need an id, lists may be left out."""
    found = json.loads(line)
    if not isinstance(found, dict) or missing(found, ("task", "lemma", "pos", "sources", "targets")):
        raise ValueError("not a query record")
    lists = ("glosses", "synonyms", "tags", "topics", "examples", "sources")
    for side in ("sources", "targets"):
        if any(not isinstance(d, dict) or missing(d, ("id",)) for d in found[side]) or len({d["id"] for d in found[side]}) < len(found[side]):
            raise ValueError(f"{side} lack an id or share one")
        found[side] = [{"id": d["id"], **{k: list(d.get(k) or ()) for k in lists}} for d in found[side]]
    return {"alignment_id": found.get("alignment_id", f"{found['task']}:{found['lemma']}.{found['pos']}"), **found}


def missing(record: dict, names: tuple[str, ...]) -> bool:
    return any(record.get(n) is None for n in names)


def read_prompts(path: str | Path) -> dict:
    """{system, tasks: {task: template}} of a TOML file."""
    found = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    return {"system": found["system"], "tasks": {k: v["template"] for k, v in found.items() if isinstance(v, dict)}}


def read_map(spark: SparkSession, path: str, value: str, key: str = "key") -> DataFrame:
    """(key, value) of a file that is one JSON object."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias(key, "value"))


def write_map(rows: DataFrame, path: str | Path, key: str, value: str) -> Path:
    """A side table as one JSON object, sorted by key, published by renaming."""
    path = Path(path)
    part = path.with_name(f"{path.name}.part")
    with part.open("w", encoding="utf-8") as out:
        out.write("{")
        for n, row in enumerate(rows.select(key, F.to_json(value).alias("v") if "struct" in dict(rows.dtypes)[value] or "array" in dict(rows.dtypes)[value] else F.to_json(F.struct(value)).alias("v")).orderBy(key).toLocalIterator()):
            out.write(("," if n else "") + f"\n{json.dumps(row[0], ensure_ascii=False)}: {row[1]}")
        out.write("\n}\n")
    return part.replace(path)
