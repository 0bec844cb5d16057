"""Byte-level BPE by corpus-level merge replay.

All distinct words of a block of documents are laid out in one linked list of symbols. An inverted index maps the
rank of every mergeable pair to the positions where it stands. Ranks are replayed in ascending order; a merge touches
its own position and its two neighbours, and only the pairs made there enter the index.

Documents of a partition are taken in blocks of BLOCK_BYTES, across the batches they arrive in, and the corpus of a replay
is the words of a block that are new. So memory is bounded by a block (or one longer document) plus a memo of MEMO chunks,
and nothing is shuffled: ids depend on the words of a document alone, so that a corpus of more words changes none.

All places of a rank are merged in one pass, of overlapping ones every other from the left. Only where such a pass makes a
pair of a lower rank, which must go before the places to its right, the word is merged by a heap of its own instead. Both
take time in proportion to a word's length (times its logarithm), however long it is.

Defined cases: a null or empty text has no ids and an empty decoding; a null id stays null; repeated rows give
repeated rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows

BLOCK_BYTES = 12 << 20
MEMO = 200_000

#: A single blank between two non-blank characters: the word pattern always starts a match there.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
BLANK_PAIR = re.compile(r" \s|\s ")


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def chunks_of(text: str) -> list[str]:
    """Cut a text where the pattern must start a new match, whatever stands around; the chunks concatenate to it."""
    if not text:
        return []
    if BLANK_PAIR.search(text):
        first, *rest = SAFE_CUT.split(text)
    else:
        first, *rest = text.split(" ")
    out = [" " + part for part in rest]
    return [first, *out] if first else out


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.memo: dict[str, bytes] = {}
        self.join: dict[int, int] = {}
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if self.bytes.min() < 0:
            raise ValueError("the vocabulary lacks a single byte")
        #: Every pair of symbols that joins to a token, sorted, and the token's rank.
        joins: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k], -1), ranks.get(token[k:], -1)
                if left >= 0 and right >= 0:
                    joins[left << 20 | right] = rank
        self.joins = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.joins.tolist()], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each two symbols joined, or -1."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)
        return np.where(self.joins[at] == key, self.joined[at], -1)

    def replay(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: every merge applied over the whole list of words, in rank order."""
        whole = [self.ranks.get(w, -1) for w in words]
        laid = [b"" if known >= 0 else w for w, known in zip(words, whole, strict=True)]
        symbol = self.bytes[np.frombuffer(b"".join(laid), np.uint8)]
        ends = np.cumsum([len(w) for w in laid], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        after = np.arange(1, len(symbol) + 1)
        before = np.arange(-1, len(symbol) - 1)
        full = ends > starts
        after[ends[full] - 1] = -1
        before[starts[full]] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        apart: dict[int, np.ndarray] = {}

        def enter(at: np.ndarray) -> None:
            """Put the pairs that start at these positions into the index."""
            if not len(at):
                return
            made = self.pair_ranks(symbol[at], symbol[after[at]])
            at, made = at[made >= 0], made[made >= 0]
            order = np.argsort(made, kind="stable")
            at, made = at[order], made[order]
            cuts = np.flatnonzero(np.diff(made)) + 1
            for rank, places in zip(made[np.concatenate([[0], cuts])].tolist() if len(made) else (), np.split(at, cuts), strict=True) if len(made) else ():
                if rank in index:
                    index[rank].append(places)
                else:
                    index[rank] = [places]
                    heapq.heappush(heap, rank)

        at = np.flatnonzero(after >= 0) if len(symbol) else np.zeros(0, np.int64)
        enter(at)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            at = np.sort(np.concatenate(places)) if len(places) > 1 else places[0]
            at = at[(symbol[at] >= 0) & (after[at] >= 0)]
            nxt = after[at]
            fits = self.pair_ranks(symbol[at], symbol[nxt]) == rank if len(at) else np.zeros(0, bool)
            at, nxt = at[fits], nxt[fits]
            if not len(at):
                continue
            # Where a place begins with the end of the one before it, every other of the run goes, from the left.
            chained = np.concatenate([[False], nxt[:-1] == at[1:]])
            if chained.any():
                place = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(chained, 0, place))
                keep = (place - begin) % 2 == 0
                at, nxt = at[keep], nxt[keep]
            follow = after[nxt]
            symbol[at] = rank
            symbol[nxt] = -1
            after[at] = follow
            there = follow >= 0
            before[follow[there]] = at[there]
            prior = before[at]
            made = np.unique(np.concatenate([prior[prior >= 0], at[there]]))
            low = self.pair_ranks(symbol[made], symbol[after[made]])
            if len(early := made[(low >= 0) & (low < rank)]):
                for word in np.unique(np.searchsorted(ends, early, side="right")).tolist():
                    apart[word] = self.merge_alone(words[word])
                    symbol[starts[word] : ends[word]] = -1
                made = made[symbol[made] >= 0]
            enter(made)
        alive = symbol >= 0
        counted = np.concatenate([[0], np.cumsum(alive)])
        ids = symbol[alive].astype("<u4")
        return [
            np.array([known], "<u4") if known >= 0 else apart[n] if n in apart else ids[counted[s] : counted[e]]
            for n, (known, s, e) in enumerate(zip(whole, starts.tolist(), ends.tolist(), strict=True))
        ]

    def merge_alone(self, word: bytes) -> np.ndarray:
        """Ids of one word, its merges taken from a heap by rank and place."""
        symbol = [int(self.bytes[b]) for b in word]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        after[-1] = -1
        join = {int(k): int(r) for k, r in zip(self.joins, self.joined, strict=True)} if not self.join else self.join
        self.join = join
        heap = [(r, i) for i in range(len(word) - 1) if (r := join.get(symbol[i] << 20 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if symbol[i] >= 0 else -1
            if j < 0 or join.get(symbol[i] << 20 | symbol[j]) != rank:
                continue
            symbol[i], symbol[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (r := join.get(symbol[left] << 20 | symbol[after[left]])) is not None:
                    heapq.heappush(heap, (r, left))
        return np.array([x for x in symbol if x >= 0], "<u4")

    def words_of(self, chunk: str) -> list[str]:
        """The matches of the word pattern in a chunk; the commonest shapes need no search."""
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isalpha():
            return [chunk]
        if body[-1:] in (".", ",") and body[:-1].isalpha():
            return [chunk[:-1], body[-1]]
        return self.pattern.findall(chunk)

    def learn(self, new: list[str]) -> None:
        """Replay the merges over all words of chunks that the memo lacks."""
        if not new:
            return
        split = list(map(self.words_of, new))
        words = list({w for ws in split for w in ws})
        done = self.replay([w.encode("utf-8", "surrogatepass") for w in words])
        ids = {w: i.tobytes() for w, i in zip(words, done, strict=True)}
        for chunk, ws in zip(new, split, strict=True):
            self.memo[chunk] = ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        new: set[str] = set()
        for text in texts:
            new.update(set(chunks_of(text)).difference(self.memo))
        self.learn(list(new))
        look = self.memo.__getitem__
        return [b"".join(map(look, chunks_of(t))) for t in texts]

    def forget(self) -> None:
        """Free what a task has learnt; workers live on."""
        self.memo.clear()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, array.array("I", ids)))


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str]]:
    """Rows one by one, whatever batches they arrive in."""
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def blocks(rows: Iterable[tuple[object, str]], limit: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str]]]:
    """Rows in blocks of about so many characters; a longer text is a block by itself."""
    block: list[tuple[object, str]] = []
    held = 0
    for key, text in rows:
        text = text or ""
        if block and held + len(text) > limit:
            yield block
            block, held = [], 0
        block.append((key, text))
        held += len(text)
    if block:
        yield block


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ids as array<int>, decoded as binary (the ids decoded again)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches):
        own = codec(path, pattern)
        for block in blocks(streamed(batches)):
            ids = own.encode_block([t for _, t in block])
            yield {
                "doc_id": [k for k, _ in block],
                "ids": [array.array("I", i).tolist() for i in ids],
                "decoded": [own.decode(i) for i in ids],
            }
        own.forget()

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(
        arrow_rows(run, schema), "doc_id long, ids array<int>, decoded binary"
    )


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, number of tokens, and SHA-256 of ids and of the decoded bytes; the ids never leave the worker."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches):
        own = codec(path, pattern)
        for block in blocks(streamed(batches)):
            ids = own.encode_block([t for _, t in block])
            yield {
                "doc_id": [k for k, _ in block],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(own.decode(i)).hexdigest() for i in ids],
            }
        own.forget()

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(
        arrow_rows(run, schema), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
