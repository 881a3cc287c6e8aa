"""Suffix-array dedup of long byte strings (operator 5).

A byte goes when a ``length``-byte string that covers it also starts anywhere
else, in the same document or another. Texts are taken as UTF-8; matches never
cross documents; strings are judged on the input.

Method. A hash-compared suffix sort: prefix polynomial hashes give the longest
common extension (LCE) of two suffixes by binary search, so one comparison in
the mergesort takes logarithmic time; extensions that lead to a removal are
verified byte by byte.

To sort few suffixes, each ``length``-byte window picks an anchor (minimum
hash among its ``gram``-byte grams). Equal windows pick equal anchors at equal
offsets, so only suffixes at anchors that occur again are sorted, in hash
ranges:

1. The windows on one anchor form a span. Equal spans (128 bits) are counted;
   from two on, all their windows repeat, and one copy stands for them.
2. Anchors with several different spans: the spans' bytes go to the anchor's
   hash range. There the suffixes at the anchors are sorted to the right and,
   reversed, to the left.
3. Anchors whose right extensions reach r form an interval of the sorted
   order. As r falls, intervals merge (smaller into larger, kept in left
   order); an inserted anchor's neighbours are those with the longest left
   extension among all that reach r. These pairs, m log m for m anchors, mark
   exactly the windows that any pair of anchors would mark.

Scale. Copies collapse map-side before any text moves, so a passage in a third
of all documents is one span, except where it meets its varying surroundings.
An anchor with more than ``hot`` different spans is not gathered in a task:
its windows are counted one by one, by hash, with partial aggregation. Long
documents are read in pieces.

Edge cases. Null text: no bytes. Rows with the same id, and equal rows, are
separate places where a string starts. Null ids are returned as null. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import rolling as r
from quarry.llm.common import Scratch, attach, id_or_last, id_or_null, n_buckets, row_tag, ship_package

LENGTH, GRAM = 400, 200
HOT = 20_000            # different spans of one anchor that a task takes
CHUNK = 1 << 20         # window starts hashed at a time
BATCH_BYTES = 1 << 20   # of spans matched at a time

_KEY = [("_id", pa.int64()), ("_tag", pa.int64())]
_SPAN = pa.schema([*_KEY, ("seed", pa.int64()), ("same", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("off", pa.int32())])
_SPAN_DDL = "_id long, _tag long, seed long, same long, first long, n int, off int"


def _chunks(data, off):
    """Window starts are taken from each part's documents, or from pieces of a long one: rows, bytes read, and the
    number of window starts that a row may have here."""
    for i, j in r.slices(off, CHUNK):
        if j == i + 1 and off[j] - off[i] > 2 * CHUNK:
            # a piece can read to the text's end and still not be the last: its starts end where the next piece begins
            yield from ((i, j, at, min(off[j], at + CHUNK + LENGTH_MAX), CHUNK) for at in range(int(off[i]), int(off[j]), CHUNK))
        else:
            yield i, j, off[i], off[j], off[j] - off[i]


LENGTH_MAX = 1 << 16


def _spans_of(col, length, gram):
    """Spans of a batch: row, first window, number of windows, anchor's offset, anchor hash, span hash."""
    data, off = r.bytes_of(col)
    for i, j, lo, hi, most in _chunks(data, off):
        part = data[lo:hi]
        if len(part) < length:
            continue
        h = r.prefix(part, r.BYTE_VALUES)
        g = r.mix(r.ngrams(h, gram))
        bits = r.U64(max(1, int(len(g)).bit_length()))
        low = (r.U64(1) << bits) - r.U64(1)
        least = r.sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), length - gram + 1) & low
        edges = np.clip(off[i: j + 1] - lo, 0, len(part))
        size = np.clip(np.diff(edges) - length + 1, 0, most)
        p = r.ragged(edges[:-1], size)
        if not len(p):
            continue
        row = np.repeat(np.arange(i, j), size)
        a = least[p].astype(np.int64)
        new = np.ones(len(p), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (row[1:] != row[:-1])
        s = np.flatnonzero(new)
        n = np.diff(np.append(s, len(p)))
        first, anchor = p[s], a[s]
        same = r.mix(r.span(h, first, first + n - 1 + length) + (n + (anchor - first) * (1 << 20)).astype(np.uint64))
        yield row[s], first + lo - off[row[s]], n, anchor - first, g[anchor], same


def _map_spans(length, gram):
    def run(batches):
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for row, first, n, at, seed, same in _spans_of(batch.column(2), length, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(tags[row]), pa.array(seed.view(np.int64)), pa.array(same.view(np.int64)),
                     pa.array(first.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))], schema=_SPAN)

    return run


_TEXT = pa.schema([("bucket", pa.int32()), *_KEY, ("seed", pa.int64()), ("first", pa.int64()), ("n", pa.int32()),
                   ("off", pa.int32()), ("alone", pa.bool_()), ("body", pa.binary())])
_TEXT_DDL = "bucket int, _id long, _tag long, seed long, first long, n int, off int, alone boolean, body binary"


def _map_bodies(length, b):
    """The bytes of the spans asked for."""
    def run(batches):
        for batch in (p for whole in batches for p in r.pieces(whole, 2)):
            out = []
            for i, tag, text, want in zip(batch.column("_id").to_pylist(), batch.column("_tag").to_pylist(), batch.column("_text"),
                                          batch.column("want").to_pylist(), strict=True):
                raw = (text.as_py() or "").encode()
                for x in want:
                    bucket = (((x["seed"] & MASK) >> 32) * b) >> 32
                    out.append((bucket, i, tag, x["seed"], x["first"], x["n"], x["off"], x["alone"],
                                raw[x["first"]: x["first"] + x["n"] - 1 + length]))
                if len(out) >= 5_000:
                    yield _rows(out, _TEXT)
                    out = []
            if out:
                yield _rows(out, _TEXT)

    return run


MASK = (1 << 64) - 1


def _rows(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Suffixes:
    """Bytes of many spans with their anchors; extensions to the right and to the left."""

    def __init__(self, bodies: list[bytes], off: np.ndarray):
        size = np.array([len(x) for x in bodies], dtype=np.int64)
        start = np.cumsum(size) - size
        self.text = np.frombuffer(b"".join(bodies) + b"\0", dtype=np.uint8)
        self.h = r.prefix(self.text, r.BYTE_VALUES)
        self.at = start + off
        self.right, self.left = size - off, off

    def lce(self, x, y, leftward: bool):
        """Longest common extension of anchors x and y, by binary search over span hashes."""
        limit = np.minimum(self.left[x], self.left[y]) if leftward else np.minimum(self.right[x], self.right[y])
        p, q = self.at[x], self.at[y]
        lo, hi = np.zeros(len(x), dtype=np.int64), limit.copy()
        for _ in range(int(limit.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            if leftward:
                same = r.span(self.h, p - mid, p) == r.span(self.h, q - mid, q)
            else:
                same = r.span(self.h, p, p + mid) == r.span(self.h, q, q + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x, y, leftward: bool, or_equal):
        """Whether suffix x sorts before y (or equals it, where asked)."""
        n = self.lce(x, y, leftward)
        have = self.left if leftward else self.right
        p, q = (self.at[x] - n - 1, self.at[y] - n - 1) if leftward else (self.at[x] + n, self.at[y] + n)
        end = n == np.minimum(have[x], have[y])
        a, b = self.text[np.where(end, 0, p)], self.text[np.where(end, 0, q)]
        return np.where(end, (have[x] < have[y]) | (or_equal & (have[x] == have[y])), a < b)

    def sort(self, group_start: np.ndarray, group_size: np.ndarray, leftward: bool) -> np.ndarray:
        """Mergesort of the suffixes of every group at once: all merges of one
        width are one array of binary searches."""
        total = int(group_size.sum())
        order = np.arange(total)
        g0, gn = np.repeat(group_start, group_size), np.repeat(group_size, group_size)
        place = np.arange(total) - g0
        width = 1
        while width < int(group_size.max(initial=0)):
            block = place // width
            odd = (block & 1).astype(bool)
            sib = np.where(odd, block - 1, block + 1) * width
            count = np.clip(gn - sib, 0, width)
            act = np.flatnonzero(count > 0)
            me, base, right = order[act], (g0 + sib)[act], odd[act]
            lo, hi = np.zeros(len(act), dtype=np.int64), count[act].copy()
            for _ in range(width.bit_length()):
                todo = np.flatnonzero(lo < hi)
                if not len(todo):
                    break
                mid = (lo[todo] + hi[todo]) >> 1
                other = order[base[todo] + mid]
                # a suffix of the right run stands after equal ones of the left run
                before = self.less(other, me[todo], leftward, right[todo])
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
            new = np.arange(total)
            run = (block[act] - right) * width
            new[act] = g0[act] + run + (place[act] - block[act] * width) + lo
            merged = np.empty(total, dtype=np.int64)
            merged[new] = order
            order = merged
            width *= 2
        return order


def _neighbours(rights: list[int], ranks: list[int]) -> list[tuple[int, int]]:
    """Pairs of one group's suffixes (in right order), see step 3 of the method.

    rights: LCE of each suffix and the next; ranks: place in left order."""
    where = {k: i for i, k in enumerate(ranks)}
    comp = list(range(len(ranks)))
    members = [[k] for k in ranks]
    pairs = []
    for e in sorted(range(len(rights)), key=lambda i: -rights[i]):
        x, y = e, e + 1
        while comp[x] != x:
            comp[x] = comp[comp[x]]
            x = comp[x]
        while comp[y] != y:
            comp[y] = comp[comp[y]]
            y = comp[y]
        if len(members[x]) < len(members[y]):
            x, y = y, x
        big = members[x]
        for k in members[y]:
            at = bisect_left(big, k)
            if at:
                pairs.append((where[k], where[big[at - 1]]))
            if at < len(big):
                pairs.append((where[k], where[big[at]]))
            big.insert(at, k)
        members[y] = []
        comp[y] = x
    return pairs


def _verified(s: _Suffixes, x, y, left, right):
    """Compares the bytes of each extension; where a hash misled, the true extension counts."""
    left, right = left.copy(), right.copy()
    size = left + right
    for lo in range(0, len(x), 4096):
        part = slice(lo, lo + 4096)
        n = size[part]
        a = s.text[r.ragged(s.at[x[part]] - left[part], n)]
        b = s.text[r.ragged(s.at[y[part]] - left[part], n)]
        if not np.array_equal(a, b):
            for k in lo + np.unique(np.repeat(np.arange(len(n)), n)[a != b]):
                for arr, have, step in ((right, s.right, 1), (left, s.left, -1)):
                    n1, limit = 0, min(have[x[k]], have[y[k]])
                    p, q = (s.at[x[k]], s.at[y[k]]) if step > 0 else (s.at[x[k]] - 1, s.at[y[k]] - 1)
                    while n1 < limit and s.text[p + step * n1] == s.text[q + step * n1]:
                        n1 += 1
                    arr[k] = n1
    return left, right


_MARK = pa.schema([*_KEY, ("first", pa.int64()), ("n", pa.int64())])


def match(seed, bodies, off, n, length):
    """Windows that repeat among spans with the same anchor hash.

    Returns (span, first window within it, count) arrays."""
    none = np.zeros(0, dtype=np.int64)
    if not len(bodies):
        return none, none, none
    by = np.argsort(seed, kind="stable")
    sd = seed[by]
    new = np.ones(len(sd), dtype=bool)
    new[1:] = sd[1:] != sd[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(sd)))
    s = _Suffixes([bodies[i] for i in by], off[by])
    order = s.sort(start, size, leftward=False)
    back = s.sort(start, size, leftward=True)
    rank = np.empty(len(back), dtype=np.int64)
    rank[back] = np.arange(len(back))
    inner = np.ones(len(sd), dtype=bool)
    inner[start] = False
    at = np.flatnonzero(inner)  # places whose predecessor is in the same group
    reach = np.zeros(len(sd), dtype=np.int64)
    reach[at] = s.lce(order[at - 1], order[at], leftward=False)
    xs, ys = [], []
    two = start[size == 2]
    xs.append(order[two]), ys.append(order[two + 1])
    for g, m in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        pairs = np.array(_neighbours(reach[g + 1: g + m].tolist(), rank[order[g: g + m]].tolist()), dtype=np.int64)
        xs.append(order[g + pairs[:, 0]]), ys.append(order[g + pairs[:, 1]])
    x, y = np.concatenate(xs), np.concatenate(ys)
    left, right = s.lce(x, y, leftward=True), s.lce(x, y, leftward=False)
    ok = left + right >= length
    x, y, left, right = x[ok], y[ok], left[ok], right[ok]
    left, right = _verified(s, x, y, left, right)
    ok = left + right >= length
    x, y, left, right = x[ok], y[ok], left[ok], right[ok]
    # window offsets o (anchor minus window start) from length - right to left
    far, near = left, np.maximum(length - right, 0)
    who, o_hi, o_lo = np.concatenate([x, y]), np.concatenate([far, far]), np.concatenate([near, near])
    return by[who], s.left[who] - o_hi, o_hi - o_lo + 1


def _batches(seed, size):
    """Ranges of spans in seed order that hold whole groups and about BATCH_BYTES, or one larger group."""
    order = np.argsort(seed, kind="stable")
    s = seed[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] != s[:-1]
    at = np.append(np.flatnonzero(new), len(s))
    upto = np.append(0, np.cumsum(size[order]))
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(upto[at], upto[at[lo]] + BATCH_BYTES, side="right")) - 1)
        yield order[at[lo]: at[hi]]
        lo = hi


def _reduce(length):
    def run(table):
        ids, tags, base, seed, n, off = (table.column(c).to_numpy() for c in ("_id", "_tag", "first", "seed", "n", "off"))
        alone = table.column("alone").to_numpy(zero_copy_only=False).astype(bool)
        bodies = [x for c in table.column("body").chunks for x in c]
        out: list[list[np.ndarray]] = [[], [], [], []]
        for part in _batches(seed, n.astype(np.int64) + length):
            who, first, count = match(seed[part], [bodies[i].as_buffer().to_pybytes() for i in part], off[part].astype(np.int64), n[part], length)
            keep = alone[part[who]]  # spans with copies are marked whole anyway
            who, first, count = part[who[keep]], first[keep], count[keep]
            for k, x in enumerate((ids[who], tags[who], base[who] + first, count)):
                out[k].append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], schema=_MARK)

    return run


_WIN = pa.schema([*_KEY, ("seed", pa.int64()), ("wh", pa.int64()), ("first", pa.int64()), ("alone", pa.bool_())])


def _map_windows(length):
    """Hot anchors: every window of a span by its hash."""
    def run(batches):
        for batch in (p for whole in batches for p in r.pieces(whole, 2)):
            for i, tag, text, want in zip(batch.column("_id").to_pylist(), batch.column("_tag").to_pylist(), batch.column("_text"),
                                          batch.column("want").to_pylist(), strict=True):
                raw = np.frombuffer((text.as_py() or "").encode(), dtype=np.uint8)
                for x in want:
                    body = raw[x["first"]: x["first"] + x["n"] - 1 + length]
                    wh = r.mix(r.ngrams(r.prefix(body, r.BYTE_VALUES), length))
                    k = len(wh)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, i)), pa.array(np.full(k, tag)), pa.array(np.full(k, x["seed"])), pa.array(wh.view(np.int64)),
                         pa.array(x["first"] + np.arange(k)), pa.array(np.full(k, x["alone"]))], schema=_WIN)

    return run


def _merge_marks(length):
    """All marks of a document as maximal byte runs, packed as uint64 pairs (start, end)."""
    def run(batches):
        for batch in batches:
            out = []
            for i, tag, first, n in zip(*(batch.column(c).to_pylist() for c in ("_id", "_tag", "first", "n")), strict=True):
                lo = np.array(first, dtype=np.int64)
                hi = lo + np.array(n, dtype=np.int64) - 1 + length
                order = np.argsort(lo)
                lo, hi = lo[order], np.maximum.accumulate(hi[order])
                new = np.ones(len(lo), dtype=bool)
                new[1:] = lo[1:] > hi[:-1]
                at = np.flatnonzero(new)
                out.append((i, tag, np.stack([lo[at], hi[np.append(at[1:], len(lo)) - 1]], axis=1).tobytes()))
            if out:
                yield _rows(out, pa.schema([*_KEY, ("runs", pa.binary())]))

    return run


_CUT = pa.schema([("_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("runs", pa.list_(pa.int64())), ("kept", pa.large_binary())])


def _cut(batches):
    for batch in (p for whole in batches for p in r.pieces(whole, 1)):
        out = []
        for i, text, runs in zip(batch.column("_id").to_pylist(), batch.column("_text"), batch.column("runs").to_pylist(), strict=True):
            raw = (text.as_py() or "").encode()
            x = np.frombuffer(runs or b"", dtype=np.int64).reshape(-1, 2)
            at, kept = 0, []
            for lo, hi in x.tolist():
                kept.append(raw[at:lo])
                at = hi
            kept.append(raw[at:])
            out.append((i, len(raw), int((x[:, 1] - x[:, 0]).sum()), len(x), x.ravel().tolist(), b"".join(kept)))
        if out:
            yield _rows(out, _CUT)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Written table of removed runs: ``(_id, _tag, runs)``, packed int64 pairs (start, end)."""
    if not gram < length <= LENGTH_MAX:
        raise ValueError(f"gram < length <= {LENGTH_MAX} is needed")
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    key = ["_id", "_tag"]
    src = docs.select(id_or_last(id_col).alias("_id"), row_tag(F.col(text_col)).alias("_tag"), F.col(text_col).alias("_text"))
    spans = scratch.write(src.mapInArrow(_map_spans(length, gram), _SPAN_DDL), "suffix-spans")
    kinds = scratch.write(
        spans.groupBy("seed", "same").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*key, "first", "n", "off")).alias("one")),
        "suffix-kinds")
    seeds = scratch.write(kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "suffix-seeds")
    # every window of a span with copies repeats
    whole = spans.join(kinds.where("copies > 1").select("seed", "same"), ["seed", "same"]).select(*key, "first", F.col("n").cast("long").alias("n"))
    asked = kinds.join(seeds, "seed").select(
        "one.*", "seed", (F.col("copies") == 1).alias("alone"), (F.col("kinds") > hot).alias("hot"))
    want = scratch.write(
        asked.groupBy(*key, "hot").agg(F.collect_list(F.struct("seed", "first", "n", "off", "alone")).alias("want")), "suffix-want")
    b = n_buckets(spark, 8)

    def wanted(hot_part):
        return attach(src, scratch.write(want.where("hot" if hot_part else "NOT hot").drop("hot"), "suffix-want"), key, "inner").select(*key, "_text", "want")

    marks = whole.unionByName(
        wanted(False).mapInArrow(_map_bodies(length, b), _TEXT_DDL).groupBy("bucket").applyInArrow(
            _reduce(length), "_id long, _tag long, first long, n long"))
    if seeds.where(F.col("kinds") > hot).limit(1).count():
        windows = scratch.write(wanted(True).mapInArrow(
            _map_windows(length), "_id long, _tag long, seed long, wh long, first long, alone boolean"), "suffix-windows")
        again = scratch.write(windows.groupBy("seed", "wh").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k"), "suffix-again")
        marks = marks.unionByName(windows.where("alone").join(again, ["seed", "wh"]).select(*key, "first", F.lit(1).cast("long").alias("n")))
    out = scratch.write(
        marks.groupBy(*key).agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n"))
        .mapInArrow(_merge_marks(length), "_id long, _tag long, runs binary"), "suffix-runs")
    scratch.drop(spans, kinds, seeds, want)
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per input row: ``(id_col, n_bytes, n_removed, n_spans, runs, kept)``; ``runs`` holds start and end of each
    removed run in turn, ``kept`` the remaining bytes."""
    runs = repeated_bytes(docs, id_col, text_col, length, gram, hot)
    src = docs.select(id_or_last(id_col).alias("_id"), row_tag(F.col(text_col)).alias("_tag"), F.col(text_col).alias("_text"))
    cut = attach(src, runs, ["_id", "_tag"]).select("_id", "_text", "runs").mapInArrow(
        _cut, "_id long, n_bytes long, n_removed long, n_spans long, runs array<long>, kept binary")
    return cut.select(id_or_null("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", "runs", "kept")
