"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import small_batches


#: Python objects of so many rows are alive at once in a worker, whatever the size of Arrow's batches.
ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A local session may do without and gets one of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="lexloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def table(df: DataFrame, name: str, clean: bool = True) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back: lineage ends here, losses replay nothing.

    With clean, the JVM is asked to collect garbage, which makes Spark delete the files of shuffles that are done with.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/lexloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    if clean:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    back = spark.read.schema(schema).parquet(path)
    back.__dict__["written_to"] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that table() has written and that no later plan reads."""
    for frame in tables:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.__dict__["written_to"])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def arrow_rows(
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turn a generator of column dictionaries into what mapInArrow takes; it is fed ROWS rows at a time."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                yield batch.slice(start, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(sliced(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in schema], schema=schema
            )

    return run


def utf8(text: str | None) -> bytes:
    """Text as UTF-8 bytes; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(doc_id, text):
    """A join key that holds for null ids and for an id with several texts."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.hex(F.xxhash64(text)))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text under fixed names, with their key."""
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.withColumn("key", key_of(F.col("doc_id"), F.col("text")))
