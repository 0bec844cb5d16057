"""Resumable alignment as a stream: new lemmas are decided once, and what is decided survives an interruption."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import alignment
from ..plans import align
from ..schema import DECISION, LEMMA


def lemma_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Collected lemmas as JSON-line files arrive."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return lines.where(F.startswith("value", F.lit("{"))).select(F.from_json("value", LEMMA).alias("r")).select("r.*")


def decided(spark: SparkSession, folder: str) -> DataFrame:
    """All decisions so far: of a source that several batches decided, the latest batch's."""
    try:
        rows = spark.read.schema(f"{DECISION}, batch long").parquet(folder)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], DECISION)
        raise
    last = rows.groupBy("alignment_id", "source_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["alignment_id", "source_id", "batch"]).drop("batch")


def decide_batch(out: str, task: str = "translations", model: align.Model = alignment.stub_model) -> Callable[[DataFrame, int], None]:
    """The body of a micro-batch: decides what the cache lacks and writes it under the batch's number.

    A batch that is run again overwrites its own folder, so a decision is never there twice.
    """

    def run(batch: DataFrame, number: int) -> None:
        queries = align.translation_queries(batch)
        found = align.decide(queries, decided(batch.sparkSession, out), task, model)
        found.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/part={number}")

    return run


def align_stream(lemmas: DataFrame, out: str, checkpoint: str, task: str = "translations", model: align.Model = alignment.stub_model) -> StreamingQuery:
    """Decide all lemmas that are there and stop; started again with the same checkpoint, only new ones."""
    return lemmas.writeStream.foreachBatch(decide_batch(out, task, model)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
