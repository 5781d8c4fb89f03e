"""64-bit hashes of words, of word sequences and of sets of them, in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed values)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=U) * U(BASE))
CHUNK = 1 << 16  # bytes that are hashed at once; a longer word makes its own chunk


class Sequences:
    """Hashes of any run of words of one text, each in constant time."""

    _up = np.ones(1, U)
    _down = np.ones(1, U)

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes)
        if len(Sequences._up) <= n:
            size = 2 * n + 1024
            with np.errstate(over="ignore"):
                Sequences._up = np.cumprod(np.r_[U(1), np.full(size, BASE, U)])
                Sequences._down = np.cumprod(np.r_[U(1), np.full(size, INVERSE, U)])
        with np.errstate(over="ignore"):
            self.upto = np.r_[U(0), np.cumsum(hashes * Sequences._up[:n])]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words ``start`` to ``end`` (exclusive)."""
        with np.errstate(over="ignore"):
            same = (self.upto[end] - self.upto[start]) * Sequences._down[start]
            return mix(same + (end - start).astype(U) * U(0xD1342543DE82EF95))


def _chunk_hashes(data: np.ndarray) -> np.ndarray:
    edge = np.diff(np.r_[True, _BLANK[data], True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return Sequences(_BYTE[data]).of(starts, ends)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word of a text in UTF-8, in order. Words end at the six ASCII blanks."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= CHUNK:
        return _chunk_hashes(raw)
    out, lo = [], 0
    while lo < len(raw):
        hi = min(lo + CHUNK, len(raw))
        while hi < len(raw) and not _BLANK[raw[hi]]:
            more = np.flatnonzero(_BLANK[raw[hi : hi + CHUNK]])
            hi = hi + int(more[0]) if len(more) else min(hi + CHUNK, len(raw))
        out.append(_chunk_hashes(raw[lo:hi]))
        lo = hi
    return np.concatenate(out)
