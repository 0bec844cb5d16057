"""Rolling hashes over bytes in numpy, in pieces of bounded size."""

from __future__ import annotations

import functools

import numpy as np

#: Bytes that are hashed at once: a piece takes some forty bytes of memory for each.
PIECE = 1 << 18
#: Longer words are hashed one by one.
LONG_WORD = 4096
BLANKS = [bytes([b]) for b in (0x20, *range(0x09, 0x0E))]
_BLANK = np.zeros(256, bool)
_BLANK[[b[0] for b in BLANKS]] = True


@functools.lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + LONG_WORD)
        base = 0x9E3779B97F4A7C15
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def sums_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of weighted bytes, and the factors that move a difference of two back to place 0."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * up, out=sums[1:])
    return sums, down


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of the k bytes from each place on."""
    n = len(data) - k + 1
    sums, down = sums_of(data)
    return mix((sums[k:] - sums[:n]) * down[:n])


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, in order; words are separated by blanks."""
    import xxhash

    out, start = [], 0
    while start < len(data):
        end = len(data)
        if end - start > PIECE:
            cut = max(data.rfind(b, start, start + PIECE) for b in BLANKS)
            if cut < 0:  # one word, longer than a piece
                end = min((at for b in BLANKS if (at := data.find(b, start + PIECE)) >= 0), default=len(data))
                out.append(np.array([xxhash.xxh3_64_intdigest(data[start:end])], np.uint64))
                start = end
                continue
            end = cut + 1
        piece = np.frombuffer(data, np.uint8, end - start, start)
        blank = np.ones(len(piece) + 2, np.int8)
        blank[1:-1] = _BLANK[piece]
        edges = np.flatnonzero(np.diff(blank))
        first, last = edges[::2], edges[1::2]
        sums, down = sums_of(piece)
        size = last - first
        found = mix((sums[last] - sums[first]) * down[first] + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            found[i] = xxhash.xxh3_64_intdigest(piece[first[i] : last[i]].tobytes())
        out.append(found)
        start = end
    return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint64)
