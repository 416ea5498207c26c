"""Array code on the bytes of many texts at once, used inside Arrow batches.

Words are runs of bytes outside the six ASCII blanks, so UTF-8 needs no decoding.
A word's hash is a polynomial over a random byte table modulo 2^64, taken from
running sums, then mixed. Long texts are hashed in blocks of words, so the memory
is a few bytes per text byte plus some words of state per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BLOCK = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_PW, _INV = _powers(_BASE, _BLOCK), _powers(pow(_BASE, -1, 2**64), _BLOCK)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """splitmix64's finaliser: every input bit moves every output bit."""
    x = x + U((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def pieces(at: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer text stands alone."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of the texts data[at[k]:at[k+1]]: starts, ends, hashes, and first[k]
    to first[k+1] as the words of text k."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = False):
        low, high = int(at[0]), int(at[-1])
        self.data, self.at = data[low:high], (at - low).astype(np.int64)
        if lower:
            self.data = LOWER[self.data]
        n = high - low
        self.solid = ~_BLANK[self.data]
        begin, end = self.solid.copy(), self.solid.copy()
        if n:
            edge = np.zeros(n + 1, bool)
            edge[self.at] = True
            begin[1:] &= ~self.solid[:-1] | edge[1:n]
            end[:-1] &= ~self.solid[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, self.at)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            base = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, base + _BLOCK - 1, "right")))
            size = int(self.ends[j - 1]) - base
            pw, inv = (_PW, _INV) if size < _BLOCK else (
                _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 2**64), size + 1))
            run = np.zeros(size + 1, np.uint64)
            np.cumsum(_TABLE[self.data[base:base + size]] * pw[:size], out=run[1:])
            s, e = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = mix((run[e] - run[s]) * inv[s] + (e - s).astype(np.uint64))
            i = j
        return out


def grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows, and first[] for them: none crosses a text."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    to = np.concatenate([[0], np.cumsum(n)])
    if not to[-1]:
        return np.zeros(0, np.uint64), to
    whole = h[:len(h) - k + 1].copy()
    for j in range(1, k):
        whole = whole * U(0x2545F4914F6CDD1D) + h[j:len(h) - k + 1 + j]
    rows = np.repeat(first[:-1] - to[:-1], n) + np.arange(to[-1])
    return mix(whole[rows], k), to
