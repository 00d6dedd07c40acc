"""Words and shingles of Arrow text columns as numpy arrays.

The functions work on the raw UTF-8 buffer of a batch, so no Python string is made per text.  A word is
a maximal run of word bytes inside one text; its 64-bit hash is a polynomial over the bytes (A-Z lowered)
with a final mix.  A null text has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes hashed at once, so that the 8-byte work arrays stay in the cache
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that white space separates: everything but space and 09-0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

#: Bytes of words made of digits, lower-case letters and anything beyond ASCII (apply LOWER first).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int):
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """The usual 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its texts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32, len(column) + 1,
                        column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


class Words:
    """Words of a batch in text order: byte spans, and the words ``first[d]:first[d + 1]`` of text d."""

    def __init__(self, column, kind: np.ndarray = SPACED):
        raw, off = text_buffer(column)
        self.bytes = LOWER[raw]
        self.offsets = off
        inside = kind[self.bytes]
        n = len(inside)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[1:], before[0] = inside[:-1], False
            after[:-1], after[-1] = inside[1:], False
            inner = off[1:-1]
            before[inner[inner < n]] = False
            after[inner[inner > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, off)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        starts, ends = self.starts, self.ends
        out = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            base = starts[a]
            b = max(a + 1, int(np.searchsorted(ends, base + PIECE, "right")))
            piece = self.bytes[base:ends[b - 1]]
            power, inverse = _power_tables(len(piece))
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:len(piece)], out=total[1:])
            s, e = starts[a:b] - base, ends[a:b] - base
            out[a:b] = (total[e] - total[s]) * inverse[s]
            a = b
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and, per text, where its runs begin (n + 1 offsets).

    A text of fewer than ``k`` words, but not none, has its whole sequence as the one run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    if n >= k:
        acc = hashes[:n - k + 1].copy()
        for j in range(1, k):
            acc = acc * np.uint64(_BASE) + hashes[j:n - k + 1 + j]
        rolled[:n - k + 1] = mix(acc + np.uint64(k))
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        acc = np.zeros(1, np.uint64)
        for h in hashes[first[d]:first[d + 1]]:
            acc = acc * np.uint64(_BASE) + h
        rolled[first[d]] = mix(acc + np.uint64(counts[d]))[0]
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], runs)
    return rolled[at], begin


def batch_texts(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Slices of a batch whose texts hold about ``limit`` bytes (one text at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    _, off = text_buffer(col)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
