"""Bounded-space online packing of token ids into fixed windows.

Each partition reads its documents once and holds OPEN windows. A piece goes to the open window that it fills best; if
none has room, the fullest is emitted and an empty one takes its place. Documents of more than a window give whole
windows first. What is open at a partition's end is merged: groups of MERGE partitions put their open windows together,
largest first into the best fitting one. Only counts and checksums of pieces leave the workers, never ids.

Defined cases: a null or empty text is its end id alone; a null id stays null; repeated rows are packed each; other
columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import array
import bisect
import functools
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table

WINDOW = 2048
OPEN = 128
MERGE = 64
END_ID = 1
MEMO = 400_000
#: Partition numbers stand above this bit of a sequence's id.
SHIFT = 40
#: White space for Python's split but not for the tokenizer.
BLANK_FOR_PYTHON = re.compile("[\x1c-\x1f]")
#: The letters that byte-level tokenizers write bytes as: visible Latin-1 characters stand for themselves.
VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in VISIBLE)}
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class WordCodec:
    """A tokenizer whose pieces never cross white space, applied to each distinct word once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        #: Texts with one of these are encoded as a whole: they stand for themselves wherever they are found.
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)", re.IGNORECASE)
        spec["normalizer"] = None
        self.words = Tokenizer.from_str(json.dumps(spec))
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def split(text: str) -> list[str]:
        """Normalised words: composed form, and lower case without the rule for a final sigma."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower().split()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        cut = [None if BLANK_FOR_PYTHON.search(t) or self.added.search(t) else self.split(t) for t in texts]
        new = {w for words in cut if words for w in words if w not in memo}
        # A word of letters and its closing mark are separate pieces, so that the word is encoded once for both.
        marked = [w for w in new if w[-1] in ".," and w[:-1].isalpha()]
        wanted = (new.difference(marked) | {w[:-1] for w in marked} | {w[-1] for w in marked}).difference(memo)
        plain = [w for w in wanted if w.isalpha()]
        tokenize = self.words.model.tokenize
        for word in plain:  # one piece: the model reads it directly, its bytes written as the byte-level step does
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
            memo[word] = array.array("I", [t.id for t in tokenize(letters)]).tobytes()
        fresh = list(wanted.difference(plain))
        for k in range(0, len(fresh), 2000):
            part = fresh[k : k + 2000]
            for word, e in zip(part, self.words.encode_batch_fast(part, add_special_tokens=False), strict=True):
                memo[word] = np.array(e.ids, "<u4").tobytes()
        for w in marked:
            memo[w] = memo[w[:-1]] + memo[w[-1]]
        look = memo.__getitem__
        return [
            np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if words is None else b"".join(map(look, words))
            for t, words in zip(texts, cut, strict=True)
        ]


@functools.lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


class Packer:
    """The windows of one partition; emitted pieces come out of add() and close()."""

    def __init__(self, partition: int, window: int = WINDOW, open_windows: int = OPEN) -> None:
        self.window, self.most = window, open_windows
        self.next = partition << SHIFT
        self.open: list[tuple[int, int]] = []  # (room, sequence), ascending
        self.held: dict[int, list[tuple]] = {}

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        out = []
        total = len(ids) // 4
        start = 0
        while total - start >= self.window:
            out.append((doc_id, start, self.window, zlib.crc32(ids[4 * start : 4 * (start + self.window)]), total, self.sequence(), 0))
            start += self.window
        size = total - start
        if size:
            at = bisect.bisect_left(self.open, (size, -1))
            if at == len(self.open):
                if len(self.open) >= self.most:
                    out += self.held.pop(self.open.pop(0)[1])
                room, seq = self.window, self.sequence()
                self.held[seq] = []
            else:
                room, seq = self.open.pop(at)
            self.held[seq].append((doc_id, start, size, zlib.crc32(ids[4 * start :]), total, seq, self.window - room))
            if room == size:
                out += self.held.pop(seq)
            else:
                bisect.insort(self.open, (room - size, seq))
        return out

    def close(self) -> list[tuple]:
        return [p for pieces in self.held.values() for p in pieces]


def place(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pieces with their window, and whether the window was still open at the end of its partition."""
    fields = [*PIECE, "open"]
    schema = pa.schema([(f, pa.bool_() if f == "open" else pa.int64()) for f in fields])
    end = np.array([end_id], "<u4").tobytes()

    def rows(pieces: list[tuple], still: bool) -> dict[str, list]:
        columns = list(zip(*pieces, strict=True)) if pieces else [[]] * len(PIECE)
        return dict(zip(fields, [*map(list, columns), [still] * len(pieces)], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        codec, packer = word_codec(path), Packer(TaskContext.get().partitionId())
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), 500):
                part = [t or "" for t in texts[k : k + 500]]
                out: list[tuple] = []
                for doc_id, ids in zip(keys[k : k + 500], codec.ids(part), strict=True):
                    out += packer.add(doc_id, ids + end)
                if out:
                    yield rows(out, False)
        if left := packer.close():
            yield rows(left, True)
        codec.memo.clear()  # workers live on

    ddl = ", ".join(f"`{f}` {'boolean' if f == 'open' else 'long'}" for f in fields)
    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(arrow_rows(run, schema), ddl)


def fit(lengths: list[tuple[int, int]], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Put whole windows together, largest first into the best fitting: (sequence, new sequence, shift)."""
    room: list[tuple[int, int]] = []
    out = []
    for size, seq in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, (size, -1))
        left, host = room.pop(at) if at < len(room) else (window, seq)
        out.append((seq, host, window - left))
        if left > size:
            bisect.insort(room, (left - size, host))
    return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in windows: gapless from 0 in each."""
    pieces = table(place(docs, path, id_col, text_col, end_id), "pieces")
    closed = pieces.where("not open").select(PIECE)
    left = pieces.where("open")

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(fit(list(zip(pdf.size_, pdf.sequence_id, strict=True))), columns=["sequence_id", "host", "shift"])

    moved = (
        left.groupBy("sequence_id").agg(F.sum("length").alias("size_"))
        .groupBy(F.expr(f"shiftright(sequence_id, {SHIFT}) div {MERGE}").alias("group"))
        .applyInPandas(merge, "sequence_id long, host long, shift long")
    )
    merged = left.join(moved, "sequence_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("host").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")
    )
    return closed.unionByName(merged)
