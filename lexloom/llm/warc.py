"""WARC archives as a chunked record table.

Writing: each partition streams its records into one archive of its own in the shared folder, a gzip member a record,
payloads in pieces of CHUNK bytes with a running digest. Only archives that a finished task reports are read, so a
repeated task leaves no second copy of a record. Reading: an archive is a stream of (record, chunk number) rows of at
most CHUNK bytes, each with the digest of the payload so far; no record is ever held as a whole.

Equal payloads of at least MIN_REVISIT bytes are stored once, with the largest page_id; the others become revisit
records that refer to it. The table of revisits holds ids and digests only, so a payload shared by very many pages costs
no payload traffic.

Defined cases: a null html is an empty payload; a null url is an empty target; a null page_id is kept as null and never
is what a revisit refers to; equal rows with the same page_id are all responses; an empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, shared_dir, small_batches, table

CHUNK = 64 << 10
MIN_REVISIT = 1000
BATCH_BYTES = 4 << 20


def header(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


class Member:
    """A gzip member that is written piece by piece."""

    def __init__(self, out) -> None:
        self.out, self.z = out, zlib.compressobj(1, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.out.write(self.z.compress(data))

    def close(self) -> None:
        self.out.write(self.z.flush())


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    digits = (urn or "")[10:-1]
    return int(digits) if digits else None


def write_record(out, page_id: int | None, url: str | None, payload: bytes | pa.Buffer, digest: str, refers_to: int | None) -> None:
    """One record: an HTTP head, then the payload unless the record is a revisit."""
    revisit = refers_to is not None
    http = header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", "".join((url or "").split())),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Length", str(len(http) + (0 if revisit else len(payload)))),
    ]
    if revisit:
        fields[1:1] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to)),
        ]
    member = Member(out)
    member.write(header(fields, "WARC/1.1"))
    member.write(http)
    if not revisit:
        view = memoryview(payload)
        for k in range(0, len(view), CHUNK):
            member.write(view[k : k + CHUNK])
    member.write(b"\r\n\r\n")
    member.close()


class Inflated:
    """Plain bytes of a file of gzip members, with bounded buffers."""

    def __init__(self, file) -> None:
        self.file, self.z, self.rest, self.buffer = file, zlib.decompressobj(31), b"", b""

    def fill(self) -> bool:
        if not self.rest:
            self.rest = self.file.read(CHUNK)
            if not self.rest:
                return False
        self.buffer += self.z.decompress(self.rest, CHUNK)
        if self.z.eof:
            self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
        else:
            self.rest = self.z.unconsumed_tail
        return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        while b"\r\n" not in self.buffer:
            if not self.fill():
                return None
        line, _, self.buffer = self.buffer.partition(b"\r\n")
        return line

    def take(self, most: int) -> bytes:
        while not self.buffer:
            if not self.fill():
                raise EOFError("an archive ends inside a record")
        out, self.buffer = self.buffer[:most], self.buffer[most:]
        return out


def head(source: Inflated) -> dict[str, str]:
    fields = {}
    while line := source.line():
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return fields


def read_records(file) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Each record's fields and its payload in pieces; the pieces must be drawn before the next record."""
    source = Inflated(file)
    while (line := source.line()) is not None:
        if not line.startswith(b"WARC/"):
            if line:
                raise ValueError("an archive has something else than a record")
            continue
        fields = head(source)
        source.line()
        left = int(fields["content-length"])
        http = head(source)
        fields["http-length"] = http.get("content-length", "0")
        left = 0 if fields["warc-type"] == "revisit" else int(fields["http-length"])

        def pieces(left: int = left) -> Iterator[bytes]:
            while left:
                piece = source.take(min(left, CHUNK))
                left -= len(piece)
                yield piece

        yield fields, pieces()


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of every page whose payload another page stores."""
    thin = pages.select("page_id", F.sha1(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length("html").alias("n"))
    thin = thin.where(F.col("n") >= min_bytes).where("page_id is not null")
    stored = thin.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to")
    return thin.join(stored, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write every page to archives; returns the archives' paths and numbers of records."""
    small_batches(pages.sparkSession)
    folder = f"{shared_dir(pages.sparkSession)}/lexloom/warc-{uuid.uuid4().hex}"
    pages = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    rows = pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")))).join(revisits(pages, min_bytes), ["page_id", "digest"], "left")
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        out, path, n = None, "", 0
        for batch in batches:
            html = batch.column(2)
            for k, (page_id, url, digest, refers_to) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True)):
                if out is None:
                    task = TaskContext.get()
                    fs, base = pa.fs.FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
                    out, path = fs.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}"
                # The payload is a view into the batch, whose bytes are limited; it is not copied.
                write_record(out, page_id, url, html[k].as_buffer() if html[k].is_valid else b"", digest, refers_to)
                n += 1
        if out is not None:
            out.close()
            yield {"path": [path], "n_records": [n]}

    written = rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(arrow_rows(run, schema), "path string, n_records long")
    return table(written, "archives")


CHUNKS = "page_id long, url string, record_type string, refers_to long, chunk int, last boolean, n_bytes long, declared_bytes long, declared_digest string, digest string"


def chunks(archives: DataFrame, data: bool = True) -> DataFrame:
    """The record table: a row for each chunk of each record, in order, with the digest of the payload up to there."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in CHUNKS.split(", ")] + [("data", pa.binary())] * data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        rows: list[tuple] = []
        held = 0

        def flush() -> dict[str, list]:
            return dict(zip([*names, *["data"] * data], map(list, zip(*rows, strict=True)), strict=True))

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = pa.fs.FileSystem.from_uri(path)
                with fs.open_input_stream(inner, compression=None) as file:
                    for fields, pieces in read_records(file):
                        fixed = (page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], page_of(fields.get("warc-refers-to")))
                        declared = (int(fields["http-length"]), base64.b32decode(fields["warc-payload-digest"][5:]).hex())
                        sha, number, seen, piece = hashlib.sha1(), 0, 0, next(pieces, b"")
                        while True:
                            sha.update(piece)
                            seen += len(piece)
                            after = next(pieces, None)
                            row = (*fixed, number, after is None, seen, *declared, sha.hexdigest())
                            rows.append((*row, piece) if data else row)
                            held += len(piece) * data + 200
                            if held > BATCH_BYTES:
                                yield flush()
                                rows, held = [], 0
                            if after is None:
                                break
                            piece, number = after, number + 1
        if rows:
            yield flush()

    # A stated number of partitions: by the column alone, adaptive execution puts all paths into one task.
    spread = archives.select("path").repartition(max(archives.count(), 1), "path")
    return spread.mapInArrow(arrow_rows(run, schema), CHUNKS + ", data binary" * data)


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write all pages and read the archives back: a row for each record, with what was really read of its payload."""
    last = chunks(write(pages, min_bytes), data=False).where("last")
    stored = F.col("record_type") == "response"
    return last.select(
        "page_id",
        F.when(stored, F.col("n_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
