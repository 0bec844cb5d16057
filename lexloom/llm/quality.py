"""Quality rules by compression bands.

A document is compressed as a whole and, from CHUNK bytes on, in fixed chunks of CHUNK bytes, the last of which ends with
the text and may overlap the one before. The ratio of plain to compressed bytes must lie
within limits that depend on the length: above them a text is repetitive, below them it is incompressible. More than
BAD_SHARE of a document's chunks outside the chunk limits rejects it too, so that one odd passage does not.

Map-only: no shuffle, memory bounded by a batch. Defined cases: a null or empty text has no words and fails the base
rule; a null id stays null; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, utf8

LEVEL = 3
CHUNK = 2048
BAD_SHARE = 0.25
CHUNK_LIMITS = (1.30, 3.2)
#: From so many bytes on: the least and the largest ratio of a whole document.
BANDS = ((0, 0.0, 3.0), (300, 1.12, 2.6), (600, 1.20, 3.0), (1200, 1.28, 3.2), (2400, 1.33, 3.4), (5000, 1.36, 3.7), (10_000, 1.38, 4.2), (30_000, 1.40, 5.5))
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@functools.lru_cache(maxsize=2)
def compressor(level: int):
    import zstandard

    return zstandard.ZstdCompressor(level=level)


def ratio(data: bytes, level: int = LEVEL) -> float:
    return len(data) / len(compressor(level).compress(data)) if data else 0.0


def limits(n_bytes: int) -> tuple[float, float]:
    """The band of a length."""
    least, most = BANDS[0][1:]
    for start, low, high in BANDS:
        if n_bytes >= start:
            least, most = low, high
    return least, most


def bands(data: bytes, level: int = LEVEL, chunk: int = CHUNK) -> tuple[float, int, int, bool]:
    """Whole ratio, number of chunks, how many of these are outside their limits, and the verdict."""
    whole = ratio(data, level)
    least, most = limits(len(data))
    if len(data) < chunk:
        return whole, 0, 0, least <= whole <= most
    starts = [*range(0, len(data) - chunk + 1, chunk)]
    if len(data) % chunk:  # a last chunk that ends with the text
        starts.append(len(data) - chunk)
    bad = sum(not CHUNK_LIMITS[0] <= ratio(data[s : s + chunk], level) <= CHUNK_LIMITS[1] for s in starts)
    return whole, len(starts), bad, least <= whole <= most and bad <= BAD_SHARE * len(starts)


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of so many words found twice or more, the first included."""
    if len(words) < size + 1:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    n, base = len(ids) - size + 1, len(seen) + 1
    key = ids[:n].copy()
    for k in range(1, size):
        if base**2 >= 2**62 or key.max() >= 2**62 // base:
            key = np.unique(key, return_inverse=True)[1]
        key = key * base + ids[k : n + k]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[back] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(size):
        covered[k : n + k] |= again
    return int(covered.sum())


def measure(text: str | None) -> dict[str, object]:
    data = utf8(text)
    text = text or ""
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    n, repeats = len(words), repeated_words(words)
    base_failed = n < 50 or 100 * repeats > 50 * n
    whole, n_chunks, bad, fine = bands(data)
    return {
        "n_words": n,
        "word_chars": len(text) - sum(map(text.count, BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeats,
        "base_failed": base_failed,
        "kept": not base_failed and fine,
        "ratio": whole,
        "n_chunks": n_chunks,
        "n_bad_chunks": bad,
    }


FIELDS = [
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
    ("base_failed", "boolean"), ("kept", "boolean"), ("ratio", "double"), ("n_chunks", "int"), ("n_bad_chunks", "int"),
]
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32()}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the counts of the base rule, the compression figures and the verdict."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, ARROW[t]) for n, t in FIELDS)])

    def run(batches):
        for batch in batches:
            rows = [measure(t) for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), **{n: [r[n] for r in rows] for n, _ in FIELDS}}

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(
        arrow_rows(run, schema), "doc_id long, " + ", ".join(f"{n} {t}" for n, t in FIELDS)
    )
