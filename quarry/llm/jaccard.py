"""N-gram Jaccard join by vertical partitioning (operator 9).

A document's set holds its distinct ``n``-word shingles (A-Z lower-cased; the
whole sequence when it has fewer words). Two documents link when
``100 * |A & B| >= 80 * |A | B|``.

Method. The global order of shingles is cut into fragments, and overlaps are
counted fragment by fragment.

1. Equal sets form a class (128-bit signature); one document stands for it.
   Overlaps are counted between classes, whatever ids their rows have; copies
   are left out before the shuffle.
2. The first third of the order (by hash), cut into fragments: each fragment
   counts how many of a document's shingles any other document has. A document
   with more than a fifth of its shingles to itself can't reach 0.8 with
   anyone and is settled: it leaves before its full set is shuffled.
3. The rest, all fragments: exact document frequencies give the global order
   (rare first). Two linked documents share a shingle in the rarest
   ``|A| - ceil(0.8 |A|) + 1`` of both.
4. Documents are put in blocks of like candidates. Blocks that share such a
   shingle are compared: per fragment the partial overlaps of all their
   documents, then the sum per pair, then the exact test.
5. Each block is first compared with itself and with its hub, the smallest
   block of most of its rare shingles. Later only blocks with documents that
   share a rare shingle and are not in one component yet are compared, so a
   family of m near copies costs its blocks, not its pairs of blocks; what
   stays outside of a shingle's largest component meets all blocks of that
   shingle.
6. Links inside a pair of blocks shrink to stars; connected components follow.

No cap, sample or probability is involved. Hash collisions aside (64 bits per
shingle, 63 per class while overlaps are counted), no link between different
texts is lost.

Edge cases. Null or empty text: empty set, component is its own id. Null id:
the row links with nothing and its component is null. Rows with one id and
different texts are one document, linked where any of its texts is. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import rolling as r
from quarry.llm.common import NO_ID, Scratch, attach, id_or_last, id_or_null, n_buckets, ship_package
from quarry.llm.components import components

SHINGLE = 5
FLUSH = 1_000_000          # shingles that a map task packs at a time
FRAGMENTS = 4              # of the order, for comparing blocks
BLOCK_DOCS, BLOCK_TOKENS = 256, 250_000
MIN_LINKED = 4             # a smaller set reaches 0.8 only with an equal one

_PACK = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("cnt", pa.binary()), ("toks", pa.binary()), ("info", pa.binary())])
_PACK_DDL = "bucket int, docs binary, cnt binary, toks binary, info binary"


def shingle_sets(col: pa.Array, n: int = SHINGLE):
    """For slices of rows: (first row, row of each distinct shingle, shingle hash, sizes)."""
    data, off = r.bytes_of(col)
    for i, j in r.slices(off):
        w = r.Words(data[off[i]: off[j]], off[i: j + 1] - off[i], lower=True)
        g, ok = w.grams(n)
        rows, g = w.row[: len(g)][ok], r.mix(g[ok])
        short = np.flatnonzero((w.count > 0) & (w.count < n))
        if len(short):
            s = w.first[short]
            whole = r.mix(r.span(w.prefix, s, s + w.count[short]) ^ r.U64(0xC3C3C3C3C3C3C3C3) * w.count[short].astype(np.uint64))
            rows, g = np.concatenate([rows, short]), np.concatenate([g, whole])
        order = np.lexsort((g, rows))
        rows, g = rows[order], g[order]
        new = np.ones(len(g), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (g[1:] != g[:-1])
        rows, g = rows[new], g[new]
        yield i, rows, g, np.bincount(rows, minlength=j - i)


def _sums(rows, values, n):
    out = np.zeros(n, dtype=np.uint64)
    if len(rows):
        new = np.ones(len(rows), dtype=bool)
        new[1:] = rows[1:] != rows[:-1]
        at = np.flatnonzero(new)
        out[rows[at]] = np.add.reduceat(values, at)
    return out


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows, strict=True), _PACK, strict=True)], schema=_PACK)


def _pack(parts, b, dtype):
    """Tokens (grouped by document) by bucket: one row per bucket."""
    ids, toks, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(bucket, kind="stable")
    ids, toks, bucket = ids[order], toks[order], bucket[order]
    found = np.unique(bucket)
    lo = np.searchsorted(bucket, found)
    for k, s, e in zip(found, lo, np.append(lo[1:], len(bucket)), strict=True):
        d = ids[s:e]
        new = np.ones(e - s, dtype=bool)
        new[1:] = d[1:] != d[:-1]
        at = np.flatnonzero(new)
        yield (int(k), d[at].tobytes(), np.diff(np.append(at, e - s)).astype(np.uint32).tobytes(),
               toks[s:e].astype(dtype).tobytes(), b"")


def _signed(rows, g, size):
    """Two signatures of each set, and the vertex that equal sets share."""
    s1, s2 = (_sums(rows, r.mix(g ^ r.U64(x)), len(size)) for x in (0x1111111111111111, 0x2222222222222222))
    return s1, s2, (r.mix(s1 ^ r.mix(s2 + size.astype(np.uint64))) >> r.U64(1)).view(np.int64)


def _fresh(v, size, seen):
    """Rows whose set, not an empty one, comes first here and isn't among those seen."""
    new = np.zeros(len(v), dtype=bool)
    new[np.unique(v, return_index=True)[1]] = True
    for x in seen:
        new &= ~np.isin(v, x)
    return new & (size > 0)


def _map_first(n, b):
    """Sizes, signatures and vertices of the sets, and the shingles in the first third of the order: once for equal sets of a flush."""
    def run(batches):
        parts, seen, held = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, rows, g, size in shingle_sets(batch.column(1), n):
                k = len(size)
                s1, s2, v = _signed(rows, g, size)
                at = ((g >> r.U64(32)) * r.U64(3 * b)) >> r.U64(32)
                part = at < b
                info = np.stack([ids[i: i + k], size, s1.view(np.int64), s2.view(np.int64), np.bincount(rows[part], minlength=k), v], axis=1)
                own = int(info[:, 2].view(np.uint64).sum() % r.U64(b))  # spreads these rows
                yield _batch([(-1 - own, b"", b"", b"", info.tobytes())])
                new = _fresh(v, size, seen)
                seen.append(v[new])
                part &= new[rows]
                parts.append((v[rows[part]], g[part], at[part].astype(np.int64)))
                held += int(part.sum())
                if held >= FLUSH:
                    yield _batch(list(_pack(parts, b, np.uint32)))
                    parts, seen, held = [], [], 0
        if held:
            yield _batch(list(_pack(parts, b, np.uint32)))

    return run


def _joined(table, name, dtype):
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=dtype) for c in table.column(name).chunks for x in c])


_FIRST = pa.schema([*((c, pa.int64()) for c in ("_id", "n", "s1", "s2", "m", "v")), ("part", pa.int32()), ("docs", pa.binary()), ("c", pa.binary())])
_FIRST_DDL = "_id long, n long, s1 long, s2 long, m long, v long, part int, docs binary, c binary"


def _parts(ids, b):
    """Part that gathers each set's results: a hash of its vertex."""
    return (((r.mix(ids.view(np.uint64)) >> r.U64(32)) * r.U64(b)) >> r.U64(32)).astype(np.int64)


def _by_part(ids, b):
    """Order of documents by part, and each part with its range."""
    part = _parts(ids, b)
    order = np.argsort(part, kind="stable")
    found, at = np.unique(part[order], return_index=True)
    return order, zip(found.tolist(), at, np.append(at[1:], len(order)), strict=True)


def _reduce_first(b):
    def run(table):
        if table.column("bucket")[0].as_py() < 0:
            info = _joined(table, "info", np.int64).reshape(-1, 6)
            k = len(info)
            return pa.Table.from_arrays([*(pa.array(info[:, i]) for i in range(6)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()),
                                         pa.nulls(k, pa.binary())], schema=_FIRST)
        docs, cnt, toks = _joined(table, "docs", np.int64), _joined(table, "cnt", np.uint32), _joined(table, "toks", np.uint32)
        entry = np.repeat(np.arange(len(docs)), cnt)
        once = np.zeros(len(docs), dtype=bool)  # equal sets come from several flushes
        once[np.unique(docs, return_index=True)[1]] = True
        entry, toks = entry[once[entry]], toks[once[entry]]
        order = np.argsort(toks, kind="stable")
        t, d = toks[order], docs[entry[order]]
        new = np.ones(len(t), dtype=bool)
        new[1:] = t[1:] != t[:-1]
        at = np.flatnonzero(new)
        shared = np.repeat(np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at), np.diff(np.append(at, len(t))))
        c = np.bincount(entry[order[shared]], minlength=len(docs))
        x = np.flatnonzero(c)
        ids, c = docs[x], c[x]
        order, parts = _by_part(ids, b)
        rows = [(k, ids[order[s:e]].tobytes(), c[order[s:e]].astype(np.int64).tobytes()) for k, s, e in parts]
        none = pa.nulls(len(rows), pa.int64())
        return pa.Table.from_arrays([*([none] * 6), *(pa.array([y[i] for y in rows], type=t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary())))],
                                    schema=_FIRST)

    return run


def _sum_first(table):
    """How many of its shingles each set of a part shares with others."""
    ids, c = _joined(table, "docs", np.int64), _joined(table, "c", np.int64)
    found, at = np.unique(ids, return_inverse=True)
    return pa.table({"v": pa.array(found), "c": pa.array(np.bincount(at, weights=c).astype(np.int64))})


def _map_all(n, b):
    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for _, rows, g, size in shingle_sets(batch.column(0), n):
                v = _signed(rows, g, size)[2]
                parts.append((v[rows], g, (((g >> r.U64(32)) * r.U64(b)) >> r.U64(32)).astype(np.int64)))
                held += len(g)
                if held >= FLUSH // 2:
                    yield _batch(list(_pack(parts, b, np.uint64)))
                    parts, held = [], 0
        if held:
            yield _batch(list(_pack(parts, b, np.uint64)))

    return run


_SHARED = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("docs", "ns", "cnt", "toks", "dfs"))])
_SHARED_DDL = "part int, docs binary, ns binary, cnt binary, toks binary, dfs binary"


def _reduce_all(b):
    """Per set: how many shingles of this fragment it has; those that others have, with their frequency."""
    def run(table):
        docs, cnt, toks = _joined(table, "docs", np.int64), _joined(table, "cnt", np.uint32), _joined(table, "toks", np.uint64)
        d = np.repeat(docs, cnt)
        order = np.lexsort((d, toks))
        t, d = toks[order], d[order]
        new_tok = np.ones(len(t), dtype=bool)
        new_tok[1:] = t[1:] != t[:-1]
        keep = new_tok.copy()
        keep[1:] |= d[1:] != d[:-1]
        t, d, new_tok = t[keep], d[keep], new_tok[keep]
        f = np.diff(np.append(np.flatnonzero(new_tok), len(t)))
        df = np.repeat(f, f)
        ids, n = np.unique(d, return_counts=True)
        x = df > 1
        order = np.argsort(d[x], kind="stable")  # shared shingles by document
        d, t, df = d[x][order], t[x][order], df[x][order].astype(np.uint32)
        lo, hi = np.searchsorted(d, ids), np.searchsorted(d, ids, side="right")
        order, parts = _by_part(ids, b)
        rows = []
        for k, s, e in parts:
            o = order[s:e]
            at = r.ragged(lo[o], hi[o] - lo[o])
            rows.append((k, ids[o].tobytes(), n[o].astype(np.int64).tobytes(), (hi - lo)[o].astype(np.int64).tobytes(),
                         t[at].tobytes(), df[at].tobytes()))
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _SHARED, strict=True)], schema=_SHARED)

    return run


_SETS = pa.schema([("v", pa.int64()), ("n", pa.int64()), ("toks", pa.binary()), ("prefix", pa.list_(pa.int64()))])
_SETS_DDL = "v long, n long, toks binary, prefix array<long>"


def _prefixes(table):
    """Sets that can still link, their shared shingles, and the rare ones that partners must share."""
    docs, ns, cnt = (_joined(table, c, np.int64) for c in ("docs", "ns", "cnt"))
    toks, dfs = _joined(table, "toks", np.uint64), _joined(table, "dfs", np.uint32)
    ids, at = np.unique(docs, return_inverse=True)
    total = np.bincount(at, weights=ns).astype(np.int64)
    own = np.repeat(at, cnt)
    order = np.lexsort((toks, dfs, own))  # the global order: rare first
    toks = toks[order]
    ends = np.cumsum(np.bincount(own, minlength=len(ids)))
    rows = []
    for i, n, s, e in zip(ids.tolist(), total.tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        k = (n - (4 * n + 4) // 5 + 1) - (n - (e - s))  # places left by shingles that nobody else has
        if k > 0:
            rows.append((i, n, toks[s:e].tobytes(), toks[s: min(e, s + k)].view(np.int64)))
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(cols, _SETS, strict=True)], schema=_SETS)


_BLOCK = pa.schema([("block", pa.int64()), ("frag", pa.int32()), ("ids", pa.list_(pa.int64())), ("ns", pa.binary()),
                    ("cnt", pa.binary()), ("toks", pa.binary())])
_BLOCK_DDL = "block long, frag int, ids array<long>, ns binary, cnt binary, toks binary"


def _blocks(block_docs):
    """Consecutive documents as blocks of bounded size, one row per block and fragment."""
    return lambda batches: _cut_blocks(batches, block_docs)


def _cut_blocks(batches, block_docs):
    seq, held, tokens = 0, [], 0

    def rows():
        block = (TaskContext.get().partitionId() << 32) | seq
        ids, ns = [x[0] for x in held], np.array([x[1] for x in held], dtype=np.int64)
        sets = [np.sort(np.frombuffer(x[2], dtype=np.uint64)) for x in held]
        for k in range(FRAGMENTS):
            lo = r.U64(k << 62)
            hi = r.U64((k + 1 << 62) - 1)
            part = [s[np.searchsorted(s, lo): np.searchsorted(s, hi, side="right")] for s in sets]
            yield (block, k, ids, ns.tobytes(), np.array([len(p) for p in part], dtype=np.uint32).tobytes(),
                   np.concatenate(part).tobytes())

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _BLOCK, strict=True)], schema=_BLOCK)

    for batch in batches:
        for x in zip(*(batch.column(c).to_pylist() for c in ("_id", "n", "toks")), strict=True):
            if held and (len(held) >= block_docs or tokens + len(x[2]) // 8 > BLOCK_TOKENS):
                yield batch_of(list(rows()))
                seq, held, tokens = seq + 1, [], 0
            held.append(x)
            tokens += len(x[2]) // 8
    if held:
        yield batch_of(list(rows()))


_PART = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ids_a", pa.list_(pa.int64())), ("ns_a", pa.binary()),
                   ("ids_b", pa.list_(pa.int64())), ("ns_b", pa.binary()), ("code", pa.binary()), ("common", pa.binary())])
_PART_DDL = "a long, b long, ids_a array<long>, ns_a binary, ids_b array<long>, ns_b binary, code binary, common binary"


def _runs_of(t, d):
    order = np.argsort(t, kind="stable")
    t, d = t[order], d[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = t[1:] != t[:-1]
    at = np.flatnonzero(new)
    return t[at], at, np.diff(np.append(at, len(t))), d


def _partial(block_docs):
    """Overlaps of one pair of blocks within one fragment of the order."""
    return lambda table: _overlaps(table, block_docs)


def _overlaps(table, block_docs):
    row = table.to_pylist()[0]
    same = row["a"] == row["b"]

    def side(x):
        cnt = np.frombuffer(row[f"cnt_{x}"], dtype=np.uint32)
        return np.frombuffer(row[f"toks_{x}"], dtype=np.uint64), np.repeat(np.arange(len(cnt)), cnt)

    ta, sa, na, da = _runs_of(*side("a"))
    tb, sb, nb, db = (ta, sa, na, da) if same else _runs_of(*side("b"))
    _, ia, ib = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
    work = na[ia] * nb[ib]
    counts = np.zeros(block_docs * block_docs, dtype=np.int64)
    cut = np.searchsorted(np.cumsum(work), np.arange(0, int(work.sum()) + 1, 2_000_000))
    edges = np.unique(np.append(cut, len(ia)))
    for lo, hi in zip(np.append(0, edges[:-1]), edges, strict=True):
        x, y = ia[lo:hi], ib[lo:hi]
        # each document of A that has the shingle, with each of B
        left = r.ragged(sa[x], na[x])
        reps = np.repeat(nb[y], na[x])
        code = np.repeat(da[left], reps) * block_docs + db[r.ragged(np.repeat(sb[y], na[x]), reps)]
        counts += np.bincount(code, minlength=len(counts))
    if same:
        i, j = np.divmod(np.arange(len(counts)), block_docs)
        counts[i >= j] = 0
    found = np.flatnonzero(counts)
    return pa.Table.from_pylist([{**{c: row[c] for c in ("a", "b", "ids_a", "ns_a", "ids_b", "ns_b")},
                                  "code": found.astype(np.uint32).tobytes(), "common": counts[found].astype(np.uint32).tobytes()}], schema=_PART)


_LINK = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _links(percent, block_docs):
    def run(table):
        """Sums the fragments of a pair of blocks, tests every pair, returns stars that keep the links' components."""
        counts = np.zeros(block_docs * block_docs, dtype=np.int64)
        for code, common in zip(table.column("code").to_pylist(), table.column("common").to_pylist(), strict=True):
            counts[np.frombuffer(code, dtype=np.uint32)] += np.frombuffer(common, dtype=np.uint32)
        ids_a, ids_b = (np.array(table.column(c)[0].as_py(), dtype=np.int64) for c in ("ids_a", "ids_b"))
        ns_a, ns_b = (np.frombuffer(table.column(c)[0].as_py(), dtype=np.int64) for c in ("ns_a", "ns_b"))
        at = np.flatnonzero(counts)
        i, j = np.divmod(at, block_docs)
        common = counts[at]
        ok = 100 * common >= percent * (ns_a[i] + ns_b[j] - common)
        root: dict[int, int] = {}

        def find(v):
            while root.get(v, v) != v:
                root[v] = root.get(root[v], root[v])
                v = root[v]
            return v

        for x, y in zip(ids_a[i[ok]].tolist(), ids_b[j[ok]].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
        out = [(v, find(v)) for v in root]  # one link per document, to the smallest of its tree
        return pa.Table.from_arrays([pa.array([k[c] for k in out], type=pa.int64()) for c in (0, 1)], schema=_LINK)

    return run


def _block_table(sets: DataFrame, tokens: DataFrame, scratch: Scratch, block_docs: int) -> DataFrame:
    """Blocks of documents, neighbours by the smallest document that shared rare shingles lead to."""
    label = sets.select("_id", F.col("_id").alias("label"))
    for _ in range(2):
        least = scratch.write(tokens.join(label, "_id").groupBy("tok").agg(F.min("label").alias("label")), "jaccard-least")
        label = scratch.write(tokens.join(least, "tok").groupBy("_id").agg(F.min("label").alias("label")), "jaccard-label")
    tasks = max(1, sets.count() // (16 * block_docs))
    return scratch.write(
        sets.join(label, "_id").repartitionByRange("label", "_id").sortWithinPartitions("label", "_id").coalesce(tasks)
        .select("_id", "n", "toks").mapInArrow(_blocks(block_docs), _BLOCK_DDL), "jaccard-blocks")


def _hubs(by_block: DataFrame) -> DataFrame:
    """``(a, b)``: every block b with the smaller block that comes first for most of its rare shingles."""
    least = by_block.groupBy("tok").agg(F.min("block").alias("a"), F.max("block").alias("last")).where("a < last").drop("last")
    shared = by_block.join(least, "tok").where("a < block").groupBy("block", "a").agg(F.count(F.lit(1)).alias("k"))
    return shared.groupBy(F.col("block").alias("b")).agg(F.max_by("a", F.struct(F.col("k"), -F.col("a"))).alias("a")).select("a", "b")


def _unsettled(tokens: DataFrame, where: DataFrame, comp: DataFrame, scratch: Scratch) -> DataFrame:
    """``(a, b)``: different blocks whose documents share a rare shingle and stand in different components.

    Per shingle, blocks with documents outside of its largest component (by
    blocks) meet its other blocks; the rest don't meet each other."""
    own = (tokens.join(where, "_id").join(comp, F.col("_id") == F.col("vertex"), "left")
           .select("tok", "block", F.coalesce("component", "_id").alias("c")).distinct())
    own = scratch.write(own, "jaccard-own")
    top = (own.groupBy("tok", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("tok")
           .agg(F.max_by("c", F.struct("k", "c")).alias("top"), F.count(F.lit(1)).alias("many")).where("many > 1").select("tok", "top"))
    top = scratch.write(top, "jaccard-top")
    rest = scratch.write(own.join(top, "tok").where("c != top").select("tok", F.col("block").alias("_block")).distinct(), "jaccard-rest")
    pairs = scratch.write(
        rest.join(own.select("tok", "block").distinct(), "tok").where("block != _block")
        .select(F.least("block", "_block").alias("a"), F.greatest("block", "_block").alias("b")).distinct(), "jaccard-pairs")
    scratch.drop(own, top, rest)
    return pairs


def _compare(pairs: DataFrame, blocks: DataFrame, percent: int, block_docs: int, scratch: Scratch) -> DataFrame:
    """Stars of the links between the documents of each pair of blocks."""
    def sided(x):
        return blocks.select(F.col("block").alias(x), "frag", *(F.col(c).alias(f"{c}_{x}") for c in ("ids", "ns", "cnt", "toks")))

    parts = pairs.join(sided("a"), "a").join(sided("b"), ["b", "frag"]).groupBy("a", "b", "frag").applyInArrow(_partial(block_docs), _PART_DDL)
    return scratch.write(parts.groupBy("a", "b").applyInArrow(_links(percent, block_docs), "x long, y long"), "jaccard-links")


def _one_document(info: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(x, y)``: an id whose rows have different sets, with the representative of each of them."""
    some = info.where((F.col("n") > 0) & (F.col("_id") != NO_ID))
    several = scratch.write(some.groupBy("_id").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo < hi").select("_id"), "jaccard-several")
    sets = some.join(several, "_id").select("_id", "n", "s1", "s2").distinct()
    return scratch.write(sets.join(classes, ["n", "s1", "s2"]).select(F.col("_id").alias("x"), F.col("rep").alias("y")), "jaccard-rows")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = 80,
           block_docs: int = BLOCK_DOCS):
    """``(info, classes, comp)``: per input row its set's size and class; each
    class's representative, its smallest id; ``(vertex, component)`` of the
    representatives that have links."""
    if percent < 80:
        raise ValueError("the bounds used here hold for a similarity of 0.8 or more")
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    b = n_buckets(spark)
    src = docs.select(id_or_last(id_col).alias("_id"), F.col(text_col).alias("_text"))
    first = scratch.write(src.mapInArrow(_map_first(n, b), _PACK_DDL).groupBy("bucket").applyInArrow(_reduce_first(b), _FIRST_DDL),
                          "jaccard-first")
    info = first.where("n IS NOT NULL").select("_id", "n", "s1", "s2", "m", "v")
    classes = scratch.write(info.groupBy("n", "s1", "s2").agg(F.min("_id").alias("rep"), F.first("m").alias("m"), F.first("v").alias("v")),
                            "jaccard-classes")
    others = first.where("part IS NOT NULL").select("part", "docs", "c").groupBy("part").applyInArrow(_sum_first, "v long, c long")
    left = scratch.write(
        classes.where((F.col("n") >= MIN_LINKED) & (F.col("rep") != NO_ID)).join(others, "v", "left")
        .where(5 * (F.col("m") - F.coalesce("c", F.lit(0))) <= F.col("n")).select("v", F.col("rep").alias("_id")), "jaccard-left")
    packed = attach(src, left.select("_id").distinct(), ["_id"], "left_semi").select("_text").mapInArrow(_map_all(n, b), _PACK_DDL)
    shared = packed.groupBy("bucket").applyInArrow(_reduce_all(b), _SHARED_DDL)
    # from here on a document is the representative of its class
    sets = scratch.write(shared.groupBy("part").applyInArrow(_prefixes, _SETS_DDL).join(left, "v").drop("v"), "jaccard-sets")
    tokens = scratch.write(sets.select(F.explode("prefix").alias("tok"), "_id"), "jaccard-tokens")
    blocks = _block_table(sets, tokens, scratch, block_docs)
    where = blocks.where("frag = 0").select("block", F.explode("ids").alias("_id"))
    by_block = scratch.write(tokens.join(where, "_id").select("tok", "block").distinct(), "jaccard-where")
    near = scratch.write(_hubs(by_block).unionByName(blocks.where("frag = 0").select(F.col("block").alias("a"), F.col("block").alias("b"))),
                         "jaccard-hubs")
    links = _compare(near, blocks, percent, block_docs, scratch)
    comp = components(links, "x", "y")
    more = _unsettled(tokens, where, comp, scratch).join(near, ["a", "b"], "left_anti")
    later = _compare(more, blocks, percent, block_docs, scratch).unionByName(_one_document(info, classes, scratch))
    if not later.isEmpty():
        comp = components(later.unionByName(comp.select(F.col("vertex").alias("x"), F.col("component").alias("y"))), "x", "y")
    scratch.drop(left, sets, tokens, blocks, by_block, near, links)
    return info, classes, comp


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = 80,
                 block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per input row: ``(id_col, n_shingles, component_id)``."""
    scratch = Scratch(docs.sparkSession)
    info, classes, comp = linked(docs, id_col, text_col, n, percent, block_docs)
    named = scratch.write(
        classes.join(comp, F.col("rep") == F.col("vertex"), "left")
        .select("n", "s1", "s2", F.coalesce("component", "rep").alias("component")), "jaccard-named")
    # a set without shingles is linked with nothing, nor is a row without an id
    alone = (F.col("n") == 0) | (F.col("_id") == NO_ID)
    return info.join(named, ["n", "s1", "s2"], "left").select(
        id_or_null("_id").alias(id_col), F.col("n").alias("n_shingles"),
        id_or_null(F.when(alone, F.col("_id")).otherwise(F.col("component"))).alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, whose id is their component's; rows without an id stay."""
    joined = jaccard_join(docs, id_col, text_col, n, percent)
    gone = Scratch(docs.sparkSession).write(
        joined.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).cast("long").alias("_gone")).distinct(), "jaccard-gone")
    names = [f"c{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*names).withColumn("_gone", F.col(names[docs.columns.index(id_col)]).cast("long"))
    return attach(d, gone, ["_gone"], "left_anti").select(*names).toDF(*docs.columns)
