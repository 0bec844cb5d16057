"""The corpus pipeline: documents through five operators, each on all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages are written as Parquet and read again in between.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import neardup, packing, pii, suffix, toxicity
from lexloom.llm.common import table
from lexloom.llm.queries import PII_KEY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars counted again."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs.select(*COLUMNS), toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the least id."""
    return neardup.survivors(docs.select(*COLUMNS), percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any string of 200 bytes that is found elsewhere too."""
    return counted(suffix.prune(docs.select(*COLUMNS)))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses as pseudonyms."""
    return counted(pii.pseudonymise(docs.select(*COLUMNS), PII_KEY))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("pii", hide_personal),
    ("packing", pack_tokens),
]

#: Learning, packing and tokenizing have no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
