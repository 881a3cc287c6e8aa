"""Substring dedup by seeds and extension (operator 8).

A window is ``n`` consecutive words of one document. A word goes when a window
that covers it also starts in a document with a smaller id.

Method. Every window picks an anchor, the minimum hash among its ``k``-word
grams (winnowing), so equal windows pick equal anchors at equal offsets.
1. Seeds: documents are joined on their anchors' hashes; runs of windows whose
   anchor stands in one document only can't repeat and go no further.
2. Extension: the other runs carry their words. Runs whose anchors have the
   same words start in one class, which is extended a word at a time to the
   right and to the left: two runs stay together as long as the next word is
   the same word (bytes compared, no hash). A window repeats where its left
   and its right extension both reach its ends together with a smaller document's.
3. Repeats that follow one another merge into the maximal repeats that go.

Scale. No pairs: a class holds all runs that agree so far. A seed or a window
that repeats within a map task's flush is settled there, and one run of the
smallest document stands for the others, so a passage in a third of all
documents costs an entry per flush, not per copy. Entries travel as packed
arrays, one row per bucket and flush; buckets follow the counted bytes. Texts
move for the runs that share a seed (once) and for the cut. Nothing is capped.

Edge cases. Null text: no words. Null id: such rows count as one document
that follows all others. Rows with the same id are one document; each keeps
its own text, and marks find their row by the id and a 64-bit hash of the text. Documents with fewer than ``n`` words lose nothing. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import rolling as r
from quarry.llm.common import attach, id_or_last, id_or_null, n_buckets, row_tag, ship_package

WINDOW, GRAM = 13, 5
FLUSH = 100_000       # runs that a map task packs at a time
BUCKET = 4 << 20      # bytes of text behind a bucket, about
SHARED = 1 << 15      # flag of a run whose seed is known to be shared

_SEED = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("tags", pa.binary()), ("runs", pa.binary()),
                   ("p0", pa.binary()), ("cnt", pa.binary()), ("seed", pa.binary())])
_SEED_DDL = "bucket int, docs binary, tags binary, runs binary, p0 binary, cnt binary, seed binary"
_RUN = pa.schema([*list(_SEED)[:-1], ("off", pa.binary()), ("words", pa.binary())])
_RUN_DDL = "bucket int, docs binary, tags binary, runs binary, p0 binary, cnt binary, off binary, words binary"
_PART = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("tags", pa.binary()), ("cnt", pa.binary()), ("spans", pa.binary())])
_PART_DDL = "part int, docs binary, tags binary, cnt binary, spans binary"
_MARK = pa.schema([("_id", pa.int64()), ("_tag", pa.int64()), ("spans", pa.binary())])
_MARK_DDL = "_id long, _tag long, spans binary"


def _table(rows, schema):
    if not rows:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _changes(*columns):
    """Where a new group of equal neighbours starts."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _windows(w, n, k):
    """Windows of a slice: first word, anchor's first word (counted in the slice), hash of the anchor."""
    m = max(0, len(w.row) - n + 1)
    first = np.flatnonzero(w.row[:m] == w.row[n - 1:]) if m else np.zeros(0, dtype=np.int64)
    if not len(first):
        return first, first, np.zeros(0, dtype=np.uint64)
    g = r.mix(w.grams(k)[0] ^ r.U64(0xA5A5A5A5A5A5A5A5))
    low = r.U64(0xFFFFFFFF)  # the same in all slices, so that ties fall alike
    anchor = r.sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), n - k + 1)
    anchor = (anchor[first] & low).astype(np.int64)
    return first, anchor, g[anchor]


def _bucket(seed, b):
    return (((seed >> r.U64(32)) * r.U64(b)) >> r.U64(32)).astype(np.int64)


def _grouped(bucket, ids, tags):
    """Entries in the order of their bucket, and per bucket its range and packed documents."""
    order = np.argsort(bucket, kind="stable")
    bucket, ids, tags = bucket[order], ids[order], tags[order]
    lo = np.flatnonzero(_changes(bucket))
    ranges = []
    for s, e in zip(lo.tolist(), np.append(lo[1:], len(bucket)).tolist(), strict=True):
        at = s + np.flatnonzero(_changes(ids[s:e], tags[s:e]))
        ranges.append((s, e, (int(bucket[s]), ids[at].tobytes(), tags[at].tobytes(), np.diff(np.append(at, e)).astype(np.uint32).tobytes())))
    return order, ranges


def _joined(table, name, dtype):
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=dtype) for c in table.column(name).chunks for x in c])


def _entries(table):
    """Documents, tags, and per run its document, first window and windows."""
    docs, tags, runs = _joined(table, "docs", np.int64), _joined(table, "tags", np.int64), _joined(table, "runs", np.uint32)
    return (docs, tags, np.repeat(np.arange(len(docs)), runs),
            _joined(table, "p0", np.uint32).astype(np.int64), _joined(table, "cnt", np.uint16).astype(np.int64))


def _spans(ids, tags, p, b):
    """Marked windows (grouped by row, ascending), packed by the part that gathers a document's marks:
    its rows and their (first window, count) pairs."""
    if not len(p):
        return _PART.empty_table()
    new_row = _changes(ids, tags)
    new = new_row.copy()
    new[1:] |= p[1:] != p[:-1] + 1
    start = np.flatnonzero(new)
    pairs = np.stack([p[start], np.diff(np.append(start, len(p)))], axis=1).astype(np.uint32)
    first = np.flatnonzero(new_row)
    at = np.searchsorted(start, first)
    cnt = np.diff(np.append(at, len(start)))
    ids, tags = ids[first], tags[first]
    part = _bucket(r.mix(ids.view(np.uint64)), b)
    order = np.argsort(part, kind="stable")
    found, lo = np.unique(part[order], return_index=True)
    rows = []
    for k, s, e in zip(found.tolist(), lo, np.append(lo[1:], len(order)), strict=True):
        o = order[s:e]
        rows.append((k, ids[o].tobytes(), tags[o].tobytes(), cnt[o].astype(np.uint32).tobytes(), pairs[r.ragged(at[o], cnt[o])].tobytes()))
    return _table(rows, _PART)


def _gather(table):
    """One row per marked text of a part."""
    docs, tags, cnt = _joined(table, "docs", np.int64), _joined(table, "tags", np.int64), _joined(table, "cnt", np.uint32).astype(np.int64)
    pairs = _joined(table, "spans", np.uint32).reshape(-1, 2)
    at = np.cumsum(cnt) - cnt
    order = np.lexsort((tags, docs))
    d, t = docs[order], tags[order]
    lo = np.flatnonzero(_changes(d, t))
    spans = [pairs[r.ragged(at[order[s:e]], cnt[order[s:e]])].tobytes() for s, e in zip(lo, np.append(lo[1:], len(d)), strict=True)]
    return pa.Table.from_arrays([pa.array(d[lo]), pa.array(t[lo]), pa.array(spans, pa.binary())], schema=_MARK)


def _seeds(n, k, b, flush_runs):
    """Runs of windows on one anchor, by the hash of the anchor."""
    def flush(parts):
        ids, tags, p0, cnt, seed = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(seed, kind="stable")
        new = _changes(seed[order])
        at, group = np.flatnonzero(new), np.cumsum(new) - 1
        d = ids[order]
        many = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
        shared, first = np.empty(len(seed), dtype=bool), np.empty(len(seed), dtype=bool)
        shared[order], first[order] = many[group], new
        # a seed of two documents of this flush: one run tells its bucket, the others pass through
        bucket = np.where(shared & ~first, -1 - int(seed[0] % r.U64(b)), _bucket(seed, b))
        cnt = np.where(shared, cnt | SHARED, cnt)
        order, ranges = _grouped(bucket, ids, tags)
        p0, cnt, seed = p0[order].astype(np.uint32), cnt[order].astype(np.uint16), seed[order]
        yield _batch([(*head, p0[s:e].tobytes(), cnt[s:e].tobytes(), seed[s:e].tobytes() if head[0] >= 0 else b"")
                      for s, e, head in ranges], _SEED)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, off = r.bytes_of(batch.column(2))
            for i, j in r.slices(off):
                w = r.Words(data[off[i]: off[j]], off[i: j + 1] - off[i])
                first, anchor, seed = _windows(w, n, k)
                row = w.row[first]
                at = np.flatnonzero(_changes(row, anchor)) if len(first) else first
                row = row[at]
                parts.append((ids[i:j][row], tags[i:j][row], first[at] - w.first[row], np.diff(np.append(at, len(first))), seed[at]))
                held += len(at)
                if held >= flush_runs:
                    yield from flush(parts)
                    held = 0
        if held:
            yield from flush(parts)

    return run


def _shared(b):
    """Windows on a seed that two documents of the bucket have."""
    def run(table):
        docs, tags, row, p0, cnt = _entries(table)
        if table.column("bucket")[0].as_py() >= 0:
            seed = _joined(table, "seed", np.uint64)
            order = np.argsort(seed, kind="stable")
            new = _changes(seed[order])
            at, group = np.flatnonzero(new), np.cumsum(new) - 1
            d = docs[row[order]]
            many = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
            many |= np.maximum.reduceat(cnt[order], at) >= SHARED
            keep = np.empty(len(seed), dtype=bool)
            keep[order] = many[group]
            row, p0, cnt = row[keep], p0[keep], cnt[keep]
        cnt = cnt & (SHARED - 1)
        row = np.repeat(row, cnt)
        return _spans(docs[row], tags[row], r.ragged(p0, cnt), b)

    return run


def _codes(words):
    """A number per different word, by its bytes."""
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def extend(codes, start, off, cnt, docs, n, k):
    """Which windows a smaller document has, by extension of equal anchors.

    A run's words begin at ``start`` in ``codes``; ``off`` words later stands
    its anchor of ``k`` words. The run has ``cnt`` windows, one from each of its first words."""
    size = int(codes.max()) + 1

    def grown(cls, at, more):
        """Classes whose next word is equal too; -1 where the run's words end."""
        out = np.full(len(cls), -1, dtype=np.int64)
        x = np.flatnonzero(more)
        out[x] = np.unique(cls[x] * size + codes[at[x]], return_inverse=True)[1]
        return out

    anchor, every, reach = start + off, np.ones(len(start), dtype=bool), n - k
    cls = codes[anchor]
    for j in range(1, k):
        cls = grown(cls, anchor + j, every)
    least_off = off - cnt + 1
    left, right = [cls], [cls]
    for j in range(1, reach + 1):
        left.append(grown(left[-1], anchor - j, off >= j))
        right.append(grown(right[-1], anchor + k + j - 1, reach - least_off >= j))
    hit, at = np.zeros(int(cnt.sum()), dtype=bool), np.cumsum(cnt) - cnt
    for o in range(reach + 1):  # windows that begin o words before the anchor
        x = np.flatnonzero((off >= o) & (least_off <= o))
        if len(x):
            both = left[o][x] * len(start) + right[reach - o][x]
            order = np.argsort(both, kind="stable")
            new = _changes(both[order])
            least = np.minimum.reduceat(docs[x][order], np.flatnonzero(new))[np.cumsum(new) - 1]
            x = x[order]
            hit[at[x] + off[x] - o] = least != docs[x]
    return hit


def _extend_flush(n, k, b):
    """Runs on shared seeds with their words, by the hash of the anchor; windows
    that a smaller document of the slice has are settled."""
    def pack(ids, tags, p, new, bucket, off, first, words):
        at = np.flatnonzero(new)
        cnt = np.diff(np.append(at, len(p)))
        order, ranges = _grouped(bucket[at], ids[at], tags[at])
        at, cnt = at[order], cnt[order]
        p0, n_win, off = p[at].astype(np.uint32), cnt.astype(np.uint16), off[at].astype(np.uint16)
        if words is None:
            return [(*head, p0[s:e].tobytes(), n_win[s:e].tobytes(), b"", b"") for s, e, head in ranges]
        sizes = np.append(0, np.cumsum(cnt + n - 1))
        bounds = pa.array(sizes[[s for s, _, _ in ranges] + [len(cnt)]].astype(np.int32))
        text = pc.binary_join(pa.ListArray.from_arrays(bounds, words.take(pa.array(r.ragged(first[at], cnt + n - 1)))), b" ")
        return [(*head, p0[s:e].tobytes(), n_win[s:e].tobytes(), off[s:e].tobytes(), t) for (s, e, head), t in zip(ranges, text, strict=True)]

    def run(batches):
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, at_row = r.bytes_of(batch.column(2))
            asked, at_span = r.bytes_of(batch.column(3))
            for i, j in r.slices(at_row):
                own, ends = data[at_row[i]: at_row[j]], at_row[i: j + 1] - at_row[i]
                w = r.Words(own, ends)
                first, anchor, seed = _windows(w, n, k)
                pairs = np.frombuffer(asked[at_span[i]: at_span[j]].tobytes(), dtype=np.uint32).reshape(-1, 2).astype(np.int64)
                from_ = w.first[np.repeat(np.arange(j - i), np.diff(at_span[i: j + 1]) // 8)] + pairs[:, 0]
                cover = np.zeros(len(w.row) + 1, dtype=np.int64)
                np.add.at(cover, from_, 1)
                np.add.at(cover, from_ + pairs[:, 1], -1)
                ask = np.cumsum(cover)[first] > 0
                first, anchor, seed = first[ask], anchor[ask], seed[ask]
                if not len(first):
                    continue
                lo, hi = r.word_bounds(own, ends)
                words = pa.Array.from_buffers(pa.large_binary(), len(lo), [None, pa.py_buffer(np.append(0, np.cumsum(hi - lo)).astype(np.int64)),
                                                                           pa.py_buffer(own[~r.WHITE_BYTE[own]])])
                row = w.row[first]
                d, t, p, off = ids[i:j][row], tags[i:j][row], first - w.first[row], anchor - first
                new = _changes(anchor)
                new[1:] |= first[1:] != first[:-1] + 1
                s = np.flatnonzero(new)
                hit = extend(_codes(words), first[s], off[s], np.diff(np.append(s, len(first))), d[s], n, k)
                rows = []
                for x, out in ((~hit, words.cast(pa.binary())), (hit, None)):
                    if x.any():
                        again = _changes(anchor[x])
                        again[1:] |= np.diff(first[x]) != 1
                        bucket = _bucket(seed[x], b) if out is not None else np.full(int(x.sum()), -1 - int(seed[0] % r.U64(b)))
                        rows += pack(d[x], t[x], p[x], again, bucket, off[x], first[x], out)
                yield _batch(rows, _RUN)

    return run


def _extend_bucket(n, k, b):
    """All runs of a bucket: mark the windows that a smaller document has."""
    def run(table):
        docs, tags, row, p0, cnt = _entries(table)
        p, at = r.ragged(p0, cnt), np.repeat(row, cnt)
        if table.column("bucket")[0].as_py() >= 0:
            words = pa.concat_arrays([pc.split_pattern(c, b" ").flatten() for c in table.column("words").chunks])
            size = cnt + n - 1
            hit = extend(_codes(words), np.cumsum(size) - size, _joined(table, "off", np.uint16).astype(np.int64), cnt, docs[row], n, k)
            p, at = p[hit], at[hit]
        return _spans(docs[at], tags[at], p, b)

    return run


def _cut(n):
    out = pa.schema([("_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.large_string())])

    def run(batches):
        for batch in (p for whole in batches for p in r.pieces(whole, 1)):
            texts = batch.column("_text")
            cols = [[], [], []]
            for text, spans in zip(texts, batch.column("spans"), strict=True):
                # bytes.split() splits at exactly the six ASCII white-space bytes
                words = (text.as_py() or "").encode().split()
                removed = 0
                if spans.is_valid:
                    x = np.frombuffer(spans.as_buffer(), dtype=np.uint32).reshape(-1, 2).astype(np.int64)
                    cover = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(cover, x[:, 0], 1)
                    np.add.at(cover, x[:, 0] + x[:, 1] - 1 + n, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = int(gone.sum())
                    words = [words[i] for i in np.flatnonzero(~gone)]
                cols[0].append(len(words) + removed)
                cols[1].append(removed)
                cols[2].append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.large_string())], schema=out)

    return run


def _source(docs, id_col, text_col):
    ship_package(docs.sparkSession)
    return docs.select(id_or_last(id_col).alias("_id"), row_tag(F.col(text_col)).alias("_tag"), F.col(text_col).alias("_text"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, k: int = GRAM,
                     flush: int = FLUSH) -> DataFrame:
    """One row per text with marked windows: ``(_id, _tag, spans)``, spans packed as uint32 pairs (first window, count)."""
    if not 0 < k <= n < SHARED:
        raise ValueError(f"the gram has 1 to {n} words, the window under {SHARED}")
    texts = _source(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    b = max(n_buckets(docs.sparkSession), size // BUCKET)
    shared = (texts.mapInArrow(_seeds(n, k, b, flush), _SEED_DDL).groupBy("bucket").applyInArrow(_shared(b), _PART_DDL)
              .groupBy("part").applyInArrow(_gather, _MARK_DDL))
    runs = attach(texts, shared, ["_id", "_tag"], "inner").select("_id", "_tag", "_text", "spans")
    return (runs.mapInArrow(_extend_flush(n, k, b), _RUN_DDL).groupBy("bucket").applyInArrow(_extend_bucket(n, k, b), _PART_DDL)
            .groupBy("part").applyInArrow(_gather, _MARK_DDL))


def seed_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, k: int = GRAM,
               flush: int = FLUSH) -> DataFrame:
    """One row per input row: ``(id_col, n_words, n_removed, kept_text)``; kept
    words are joined by one space. See the module's docstring for the rules."""
    marks = repeated_windows(docs, id_col, text_col, n, k, flush)
    joined = attach(_source(docs, id_col, text_col), marks, ["_id", "_tag"])
    cut = joined.select("_id", "_text", "spans").mapInArrow(_cut(n), "_id long, n_words long, n_removed long, kept_text string")
    return cut.select(id_or_null("_id").alias(id_col), "n_words", "n_removed", "kept_text")
