"""Arrow batches that a small executor can hold."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows and bytes of an Arrow batch on its way to a worker: each task holds one in the JVM and one in Python.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to what a small executor can hold twice a task; never raises them."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(name).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))
