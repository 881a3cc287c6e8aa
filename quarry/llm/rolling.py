"""Vectorised rolling hashes over the bytes and words of Arrow string columns.

Polynomial hashes modulo 2^64 with an odd base: prefix sums of
``value[i] * BASE**i`` give the hash of any span as one subtraction and one
multiplication by the inverse power, so n-gram hashes, window hashes and
longest-common-extension probes are array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 20  # bytes or words hashed at a time

_tables: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < PIECE, made once per worker; larger powers are products."""
    if not _tables:
        for base in (BASE, INVERSE):
            t = np.full(PIECE, base, dtype=np.uint64)
            t[0] = 1
            np.cumprod(t, out=t)
            _tables.append(t)
    return _tables[0], _tables[1]


def inverse(at: np.ndarray) -> np.ndarray:
    """BASE**-at for an array of positions."""
    inv = _powers()[1]
    if not len(at) or int(at.max()) < PIECE:
        return inv[at]
    step = pow(INVERSE, PIECE, 1 << 64)
    high = np.array([pow(step, k, 1 << 64) for k in range((int(at.max()) >> 20) + 1)], dtype=np.uint64)
    return inv[at & (PIECE - 1)] * high[at >> 20]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U64(BASE))
WHITE_BYTE = np.zeros(256, dtype=bool)
WHITE_BYTE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prefix(values: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Prefix hashes, one more than values; with ``table``, values are indices into it."""
    p = _powers()[0]
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    for k, at in enumerate(range(0, len(values), PIECE)):
        part = values[at: at + PIECE]
        x = (part if table is None else table[part]) * p[: len(part)]
        if k:
            x *= U64(pow(BASE, at, 1 << 64))
        np.cumsum(x, out=x)
        x += out[at]
        out[at + 1: at + 1 + len(part)] = x
    return out


def span(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of each span [lo, hi), the same wherever it stands."""
    return (h[hi] - h[lo]) * inverse(lo)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values."""
    if len(h) <= n:
        return np.zeros(0, dtype=np.uint64)
    out = h[n:] - h[:-n]
    inv = _powers()[1]
    for k, at in enumerate(range(0, len(out), PIECE)):
        part = out[at: at + PIECE]
        part *= inv[: len(part)]
        if k:
            part *= U64(pow(INVERSE, at, 1 << 64))
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < w:
        x = np.minimum(x[: len(x) - (w - size)], x[w - size:])
    return x


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(col) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pieces(batch: pa.RecordBatch, at: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes in column ``at`` each, or one row: bounds what a task holds as objects."""
    _, off = bytes_of(batch.column(at))
    for i, j in slices(off, limit):
        yield batch.slice(i, j - i)


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words end at the end of their row."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    solid = ~WHITE_BYTE[data]
    cut = np.zeros(n + 1, dtype=bool)  # a row starts here
    cut[off] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hash of every word; words over PIECE bytes go to xxhash."""
    out = np.empty(len(lo), dtype=np.uint64)
    i, n = 0, len(lo)
    while i < n:
        if hi[i] - lo[i] > PIECE:
            out[i] = xxhash.xxh3_64_intdigest(data[lo[i]: hi[i]].tobytes())
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(hi, lo[i] + PIECE, side="right")))
        at = lo[i]
        h = prefix(data[at: hi[j - 1]], BYTE_VALUES)
        out[i:j] = mix(span(h, lo[i:j] - at, hi[i:j] - at) + (hi[i:j] - lo[i:j]).astype(np.uint64))
        i = j
    return out


class Words:
    """The words of a slice of rows: hashes, row of each word, first word of each row."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False):
        if lower:
            data = LOWER[data]
        lo, hi = word_bounds(data, off)
        self.hash = word_hashes(data, lo, hi)
        self.first = np.searchsorted(lo, off)  # n + 1 positions
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(off) - 1), self.count)
        self.prefix = prefix(self.hash)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every n consecutive words, and which of them stay in one row."""
        g = ngrams(self.prefix, n)
        return g, self.row[: len(g)] == self.row[n - 1: n - 1 + len(g)]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + count)."""
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts.astype(np.int64) - before, counts) + np.arange(total)
