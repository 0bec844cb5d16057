"""Sinks: JSON lines, TSV, reports and manifests, published as a whole."""

from __future__ import annotations

import contextlib
import csv
import json
import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import open_any

MANIFEST = "manifest.json"


def without_empty(col: Column, kind: T.DataType) -> Column:
    """Empty strings, arrays and maps as null, at every level; to_json then leaves them out. 0 and false stay."""
    if isinstance(kind, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(kind, T.ArrayType):
        shown = F.transform(col, lambda x: without_empty(x, kind.elementType)) if isinstance(kind.elementType, (T.StructType, T.ArrayType)) else col
        return F.when(F.size(col) > 0, shown)
    if isinstance(kind, T.MapType):
        return F.when(F.size(col) > 0, col)
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[without_empty(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return col


def to_lines(df: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One JSON line a row, in the rows' order."""
    kept = [f for f in df.schema.fields if f.name != ordinal]
    shaped = F.to_json(F.struct(*[without_empty(F.col(f.name), f.dataType).alias(f.name) for f in kept]))
    return (df.orderBy(ordinal) if ordinal else df).select(shaped.alias("value"))


def write_json_lines(df: DataFrame, path: str | Path, ordinal: str | None = None) -> Path:
    """One file, compressed by its suffix; rows stream through the driver one partition at a time."""
    path = Path(path)
    part = path.with_name(f"{path.name}.part")
    with open_any(part, "wb") as out:
        for row in to_lines(df, ordinal).toLocalIterator():
            out.write(row.value.encode() + b"\n")
    return part.replace(path)


def write_tsv(rows: Iterator[dict], path: str | Path, fields: tuple[str, ...]) -> Path:
    """Rows with blanks for what is missing; an undeclared column is an error."""
    path = Path(path)
    part = path.with_name(f"{path.name}.part")
    with open_any(part, "wb") as raw:
        class Text:
            def write(self, line: str) -> None:
                raw.write(line.encode())

        writer = csv.DictWriter(Text(), fields, restval="", extrasaction="raise", dialect="excel-tab")
        writer.writeheader()
        for row in rows:
            writer.writerow(row)
    return part.replace(path)


WRITERS = {".jsonl": write_json_lines}


def writer_for(path: str | Path):
    """The writer that a name's suffix asks for, looking through compression."""
    name = str(path)
    for suffix in (".gz", ".bz2", ".zst"):
        name = name.removesuffix(suffix)
    if (found := WRITERS.get(Path(name).suffix)) is None:
        raise ValueError(f"{path}: no writer; known are {', '.join(sorted(WRITERS))}")
    return found


def write_json(value: object, path: str | Path) -> Path:
    path = Path(path)
    path.write_text(json.dumps(value, indent=4, ensure_ascii=False) + "\n", encoding="utf-8")
    return path


@contextlib.contextmanager
def published(folder: str | Path) -> Iterator[Path]:
    """A staging folder whose files replace those of `folder` one by one at the end, the manifest last; none if it fails."""
    folder = Path(folder)
    if folder.is_file():
        raise NotADirectoryError(folder)
    staging = folder.with_name(f".{folder.name}-{uuid.uuid4().hex}")
    staging.mkdir(parents=True)
    try:
        yield staging
        folder.mkdir(parents=True, exist_ok=True)
        for file in sorted(staging.rglob("*"), key=lambda p: (p.name == MANIFEST, str(p))):
            if file.is_file():
                target = folder / file.relative_to(staging)
                target.parent.mkdir(parents=True, exist_ok=True)
                file.replace(target)
    finally:
        shutil.rmtree(staging, ignore_errors=True)
