"""Scans of text files, transparent to compression, with an ordinal that holds across partitions."""

from __future__ import annotations

import bz2
import contextlib
import gzip
import io
import tarfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PAGE, RAW_ENTRY

CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line): lines of one or many files. ord is (file, block, place), which sorts as the files read."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return lines.select(F.struct(F.col("file_path").alias("file"), F.col("file_block_start").alias("block"), F.monotonically_increasing_id().alias("place")).alias("ord"), F.col("value").alias("line"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines with their ord; other lines and broken ones are skipped, wrong fields are null."""
    rows = numbered_lines(spark, path).where(F.startswith("line", F.lit("{")))
    parsed = rows.select("ord", F.from_json("line", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    # A wrongly typed field also marks a record as corrupt, but leaves the others; a broken line has no field at all.
    fields = spark.createDataFrame([], schema).columns
    some = F.lit(0)
    for c in fields:
        some = some + F.col(f"r.{c}").isNotNull().cast("int")
    return parsed.where(some > 0).select("ord", *[f"r.{c}" for c in fields])


def line_counts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row: n_lines, n_records, n_other (lines that don't begin with a brace) and n_broken, which json_lines() skips."""
    fields = spark.createDataFrame([], schema).columns
    record = F.from_json("line", schema)
    held = F.lit(False)
    for c in fields:
        held = held | record[c].isNotNull()
    braced = F.startswith("line", F.lit("{"))
    return numbered_lines(spark, path).agg(
        F.count("*").alias("n_lines"), F.count_if(braced & held).alias("n_records"),
        F.count_if(~braced).alias("n_other"), F.count_if(braced & ~held).alias("n_broken"),
    )


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Raw entries; the schema is the column pruning."""
    return json_lines(spark, path, RAW_ENTRY)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(title, markup) of the articles of a MediaWiki dump."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return pages.where("ns = 0 and title <> '' and revision.text <> ''").select("title", F.col("revision.text").alias("markup"))


def codec_of(path: str | Path) -> str | None:
    """The codec that a name's suffix tells, looking through ".part"."""
    name = Path(str(path).removesuffix(".part"))
    return CODECS.get(name.suffix)


def existing(path: str | Path) -> Path | None:
    """A file or its compressed sibling."""
    return next((p for p in map(Path, (f"{path}{s}" for s in ("", *CODECS))) if p.is_file()), None)


@contextlib.contextmanager
def open_any(path: str | Path, mode: str = "rb") -> Iterator[io.BufferedIOBase]:
    """A file opened through its codec."""
    codec = codec_of(path)
    if codec == "zstd":
        stream = pa.input_stream(str(path), compression="zstd") if "r" in mode else pa.output_stream(str(path), compression="zstd")
    else:
        stream = {"gzip": gzip.open, "bz2": bz2.open, None: open}[codec](path, mode)
    try:
        yield stream
    finally:
        stream.close()


def archive_lines(path: str | Path, name: str) -> Iterator[str]:
    """Lines of the first member of a tar archive with this base name, streamed."""
    with open_any(path) as raw, tarfile.open(fileobj=raw, mode="r|") as archive:
        for member in archive:
            if member.isfile() and Path(member.name).name == name:
                for line in archive.extractfile(member):
                    yield line.decode("utf-8")
                return
    raise FileNotFoundError(f"{path} has no {name}")


def publish_archive(folder: str | Path, out: str | Path) -> Path:
    """A folder as a tar archive, compressed by the suffix."""
    out = Path(out)
    part = out.with_name(f"{out.name}.part")
    with open_any(part, "wb") as raw, tarfile.open(fileobj=raw, mode="w|") as archive:
        archive.add(folder, arcname=Path(folder).name)
    return part.replace(out)
