"""Shape features of whole texts, computed on the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quarry.llm import rolling as r

NAMES = ("log_words", "mean_word", "long_words", "symbols", "upper", "digits", "marks", "ends_in_symbol", "non_ascii",
         "lines", "repeated_lines", "distinct_words", "top_word", "repeated_pairs", "bars", "one_letter_words", "tags", "line_breaks")

_SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _HIGH, _BAR, _TAG, _LINE = range(9)
_CLASS = np.zeros((9, 256), dtype=bool)
for _k, _chars in ((_SYMBOL, "#*$%&|<>@^~_={}[]\\"), (_MARK, "!?.,;:"), (_BAR, "|"), (_TAG, "<>{}"), (_LINE, "\n")):
    _CLASS[_k, [ord(c) for c in _chars]] = True
_CLASS[_UPPER, 65:91] = _CLASS[_LOWER, 97:123] = _CLASS[_DIGIT, 48:58] = _CLASS[_HIGH, 128:] = True


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags)])
    return (c[off[1:]] - c[off[:-1]]).astype(float)


def _distinct(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and the most frequent one's count."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(rows)))
    top = np.zeros(n)
    np.maximum.at(top, rows[at], count)
    return np.bincount(rows[at], minlength=n).astype(float), top


def features(col: pa.Array) -> np.ndarray:
    """A row of features (see NAMES) for each text; null and empty texts give the same row."""
    data, off = r.bytes_of(col)
    out = np.zeros((len(off) - 1, len(NAMES)))
    for i, j in r.slices(off):
        d, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
        k = j - i
        w = r.Words(d, o)
        n = w.count.astype(float)
        lo, hi = r.word_bounds(d, o)
        size = (hi - lo).astype(float)
        chars = np.maximum(np.diff(o).astype(float), 1)
        some = np.maximum(n, 1)
        by = {c: _per_row(_CLASS[c][d], o) for c in range(9)}
        ends = np.bincount(w.row, weights=_CLASS[_SYMBOL][d[hi - 1]], minlength=k) if len(lo) else np.zeros(k)
        words, top = _distinct(w.row, w.hash, k)
        pairs, ok = w.grams(2)
        pairs_row = w.row[: len(pairs)][ok]
        n_pairs = np.bincount(pairs_row, minlength=k).astype(float)
        d_pairs, _ = _distinct(pairs_row, pairs[ok], k)
        # lines by a hash of their words, lines without words left out
        n_lines = by[_LINE] + 1
        line = np.cumsum(_CLASS[_LINE][d])[lo] + w.row if len(lo) else np.zeros(0, dtype=np.int64)
        new = np.ones(len(line), dtype=bool)
        new[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(line))
        hashes = r.span(w.prefix, first, last) if len(first) else np.zeros(0, dtype=np.uint64)
        full = np.bincount(w.row[first], minlength=k).astype(float)
        d_lines, _ = _distinct(w.row[first], hashes, k)
        mean = np.bincount(w.row, weights=size, minlength=k) / some
        out[i:j] = np.stack([
            np.log1p(n), mean, np.bincount(w.row, weights=size > 12, minlength=k) / some, by[_SYMBOL] / chars,
            by[_UPPER] / np.maximum(by[_UPPER] + by[_LOWER], 1), by[_DIGIT] / chars, by[_MARK] / some, ends / some, by[_HIGH] / chars,
            np.log1p(n_lines), 1 - d_lines / np.maximum(full, 1) * (full > 0) - (full == 0), words / some, top / some,
            (n_pairs - d_pairs) / np.maximum(n_pairs, 1), by[_BAR] / some, np.bincount(w.row, weights=size == 1, minlength=k) / some,
            by[_TAG] / chars, n_lines / some], axis=1)
    empty = np.flatnonzero(np.diff(off) == 0)
    out[empty] = 0
    return out
