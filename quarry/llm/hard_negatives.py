"""Hard-negative mining by exact integer scores (operator 11).

Each row has an id, a label and a vector. A component ``x`` becomes
``floor(scale * x)``; the score of two rows is their integer inner product.
An anchor's positives are the ``n_positives`` other rows of its label with the
highest scores; for each of them the ``n_negatives`` best rows of other labels
are taken whose score lies between ``low`` and ``high`` percent of the
positive's. Equal scores go by the smaller id.

Method. Residue-number-system GEMM: matrices of residues modulo small primes
are multiplied in float32, where every partial sum is a whole number of at most
2^24 and hence exact. Signed scores come back by Chinese remaindering (mixed
radix, balanced digits); as many primes are taken as the largest norm of the
table asks for. Windowed selection follows: each pair of blocks keeps the best
of its own rows, a window over the kept ones decides.

Scale. Rows stand in blocks of bounded bytes. A label with many rows has blocks
of its own, rare labels share blocks, so the search for positives meets only
blocks of one group and the search for negatives only the others. Anchors meet
all rows block by block; a task holds one block of anchors and one of rows, and
a block's own selection bounds what is shuffled. A hot label is many blocks.

Edge cases. Rows with a null label, a null vector, or a null, NaN or infinite
component take no part. Quantised components beyond 2^24 count as 2^24, so that
scores fit 64 bits; shorter vectors are filled up with zeros, and one of more
than 16,384 components raises an error. A null id follows all others and is
never an anchor. Each of the rows that repeat with one id is a row of its own:
an anchor is not its own positive, but a repeated row of it is one. Empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, id_or_last, id_or_null, sent_whole, ship_package
from quarry.operators.indexing import row_index

LARGEST = 1 << 24        # of a quantised component
MOST_DIMS = 1 << 14
EXACT = 1 << 24          # whole numbers up to it are exact in float32
DEPTH = 1024             # components multiplied at a time
ROW_BLOCK = 4 << 20      # bytes of a block of rows
ANCHOR_BLOCK = 1 << 20   # bytes of a block of anchors
CELLS = 1 << 19          # scores held at a time

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def moduli(bound: int, dims: int) -> list[int]:
    """Primes whose product is over ``4 * bound`` and whose products of residues add up exactly in float32."""
    p = min(2 * math.isqrt(EXACT // max(1, min(dims, DEPTH))) + 1, math.isqrt(EXACT) - 1)  # the latter for the products of digits
    out, product = [], 1
    while product <= 4 * bound or not out:
        if p < 3:
            raise ValueError("too few primes for these scores")
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers in float32, brought next to zero modulo p."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def residues(q: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [(((q + p // 2) % p) - p // 2).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products, as int64, of all rows behind two lists of residue matrices."""
    digits, out, weight = [], None, 1
    for k, p in enumerate(primes):
        dims, r = a[k].shape[1], None
        for at in range(0, dims, DEPTH):
            part = _balanced(a[k][:, at: at + DEPTH] @ b[k][:, at: at + DEPTH].T, p)
            r = part if r is None else r + part
        r = _balanced(r, p)
        for v, p0 in zip(digits, primes):
            i = pow(p0, -1, p)
            r = _balanced((r - v) * np.float32(i if i <= p // 2 else i - p), p)
        digits.append(r)
        term = r.astype(np.int64) * np.array(weight % (1 << 64), dtype=np.uint64).astype(np.int64)
        out = term if out is None else out + term
        weight *= p
    return out


def best(s: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest allowed scores of each row, earlier columns first among equals."""
    low = np.iinfo(np.int64).min
    s = np.where(ok, s, low)
    floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), low)
    r, c = np.nonzero((s >= floor[:, None]) & ok)
    order = np.lexsort((c, -s[r, c], r))
    r, c = r[order], c[order]
    first = np.searchsorted(r, np.arange(len(s)))
    keep = np.arange(len(r)) - first[r] < k
    return r[keep], c[keep]


def within(s: np.ndarray, ok: np.ndarray, ask: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Request and column of the k best allowed scores in [lo, hi] of each request's row ``ask``."""
    n = len(s)
    least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, ask, lo)
    np.maximum.at(most, ask, hi)
    r, c = np.nonzero(ok & (s >= least[:, None]) & (s <= most[:, None]))
    if not len(r):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found = s[r, c]
    level, rank = np.unique(found, return_inverse=True)
    step = len(level) + 1
    place = r * step + (step - 1 - rank)                  # by row, best first; columns in order
    order = np.argsort(place, kind="stable")
    place = place[order]
    start = np.searchsorted(place, ask * step + (step - np.searchsorted(level, hi, side="right")))
    end = np.searchsorted(place, ask * step + (step - 1 - np.searchsorted(level, lo)), side="right")
    take = np.clip(end - start, 0, k)
    req = np.repeat(np.arange(len(ask)), take)
    at = np.repeat(start, take) + np.arange(len(req)) - np.repeat(np.cumsum(take) - take, take)
    return req, c[order][at]


PACKED = "grp string, pure boolean, row binary, id binary, label binary, q binary"


def _pack(dims: int):
    def pack(rows: pa.Table) -> pa.Table:
        t = rows.sort_by([("id", "ascending"), ("row", "ascending")])
        q = np.zeros((t.num_rows, dims), dtype=np.int32)
        v = t["q"].combine_chunks()
        size = np.diff(v.offsets.to_numpy())
        filled = np.arange(dims)[None, :] < size[:, None]
        q[filled] = v.flatten().to_numpy(zero_copy_only=False)
        cols = [t[c].to_numpy().astype(np.int64).tobytes() for c in ("row", "id", "label")]
        return pa.table({"grp": t["grp"][:1], "pure": t["pure"][:1], **{n: pa.array([c], pa.binary()) for n, c in zip(("row", "id", "label"), cols)},
                         "q": pa.array([q.tobytes()], pa.binary())})
    return pack


def _block(t: pa.Table, dims: int):
    ints = [np.frombuffer(t[c][0].as_py(), dtype=np.int64) for c in ("row", "id", "label")]
    return *ints, np.frombuffer(t["q"][0].as_py(), dtype=np.int32).reshape(-1, dims)


def _cells(anchors: pa.Table, rows: pa.Table, dims: int, primes: list[int]):
    """Scores of a block of anchors with a block of rows, some anchors at a time."""
    a, b = _block(anchors, dims), _block(rows, dims)
    rb = residues(b[3], primes)
    step = max(1, CELLS // max(1, len(b[0])))
    for i in range(0, len(a[0]), step):
        j = min(len(a[0]), i + step)
        yield i, j, scores(residues(a[3][i:j], primes), rb, primes), a, b


def _ids(x: np.ndarray) -> pa.Array:
    return pa.array(x, pa.int64())


def _positives(dims: int, primes: list[int], k: int):
    def find(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        cols = [[] for _ in range(5)]
        if anchors.num_rows and rows.num_rows:
            for i, j, s, a, b in _cells(anchors, rows, dims, primes):
                r, c = best(s, (a[2][i:j, None] == b[2][None, :]) & (a[0][i:j, None] != b[0][None, :]), k)
                for col, x in zip(cols, (a[0][i:j][r], b[0][c], b[1][c], s[r, c])):
                    col.append(x)
                cols[4].append(np.full(len(r), key[0].as_py(), dtype=np.int64))
        return pa.table({n: _ids(np.concatenate(col) if col else np.zeros(0, dtype=np.int64))
                         for n, col in zip(("a_row", "p_row", "p_id", "p_score", "a"), cols)})
    return find


def share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``score * percent / 100``, rounded up or down, without overflow."""
    whole, rest = np.divmod(score, 100)
    return whole * percent + (-((-rest * percent) // 100) if up else rest * percent // 100)


def _negatives(dims: int, primes: list[int], k: int, low: int, high: int):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        names = ("a_row", "a_id", "p_row", "p_id", "p_score", "n_row", "n_id", "n_score")
        cols = [[] for _ in names]
        if anchors.num_rows and rows.num_rows:
            asked = anchors["asked"].combine_chunks().flatten()
            a_row, p_row, p_id, p_score = (asked.field(n).to_numpy() for n in ("a_row", "p_row", "p_id", "p_score"))
            own = _block(anchors, dims)[0]
            by_row = np.argsort(own)
            at = by_row[np.searchsorted(own, a_row, sorter=by_row)]
            lo, hi = share(p_score, low, True), share(p_score, high, False)
            for i, j, s, a, b in _cells(anchors, rows, dims, primes):
                mine = np.flatnonzero((at >= i) & (at < j))
                req, c = within(s, a[2][i:j, None] != b[2][None, :], at[mine] - i, lo[mine], hi[mine], k)
                m = mine[req]
                for col, x in zip(cols, (a_row[m], a[1][at[m]], p_row[m], p_id[m], p_score[m], b[0][c], b[1][c], s[at[m] - i, c])):
                    col.append(x)
        return pa.table({n: _ids(np.concatenate(col) if col else np.zeros(0, dtype=np.int64)) for n, col in zip(names, cols)})
    return find


def quantised(vectors: DataFrame, label: Column, is_anchor: Column, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, label, anchor, q)`` of the rows that take part."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform(vec_col, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return (vectors.select(id_or_last(id_col).alias("id"), label.cast("long").alias("label"),
                           (F.col(id_col).isNotNull() & F.coalesce(is_anchor, F.lit(False))).alias("anchor"),
                           F.col(vec_col).alias("_v"), F.col(vec_col).isNotNull().alias("_has"), finite.alias("_ok"), q.alias("q"))
            .where("label is not null and _has and _ok").select("id", "label", "anchor", "q"))


def _groups(rows: DataFrame, row_block: int, anchor_block: int, scratch: Scratch) -> DataFrame:
    """``(label, grp, pure, row_blocks, anchor_blocks)``: labels that fill half a block are groups of their own."""
    per = scratch.write(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("long")).alias("m")), "mining-labels")
    rare = per.where(F.col("n") < row_block // 2).agg(F.sum("n")).first()[0] or 0
    pure = F.col("n") >= row_block // 2
    named = per.select("label", "n", "m", pure.alias("pure"), F.when(pure, F.concat(F.lit("="), "label")).otherwise(
        F.concat(F.lit("~"), F.pmod(F.xxhash64("label"), F.lit(max(1, math.ceil(rare / row_block)))))).alias("grp"))
    sizes = named.groupBy("grp").agg(F.ceil(F.sum("n") / row_block).alias("row_blocks"),
                                     F.greatest(F.ceil(F.sum("m") / anchor_block), F.lit(1)).alias("anchor_blocks"))
    out = scratch.write(named.join(sizes, "grp").select("label", "grp", "pure", "row_blocks", "anchor_blocks"), "mining-groups")
    scratch.drop(per)
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: str | Column = "label", id_col: str = "vec_id", vec_col: str = "embedding",
                   scale: int = 256, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
                   row_block: int | None = None, anchor_block: int | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; see the module.

    ``row_block`` and ``anchor_block`` are rows of a block, by default as many as the byte bounds hold."""
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    label = F.col(label) if isinstance(label, str) else label
    rows = scratch.write(quantised(vectors, label, is_anchor, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id()), "mining-rows")
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda x, y: x + y.cast("long") * y.cast("long"))
    dims, bound, n_anchors = rows.agg(F.max(F.size("q")), F.max(norm), F.sum(F.col("anchor").cast("long"))).first()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} components; {MOST_DIMS} at most")
    dims = max(dims, 1)
    primes = moduli(bound, dims)
    row_block = row_block or max(64, ROW_BLOCK // (4 * dims))
    anchor_block = anchor_block or max(64, ANCHOR_BLOCK // (4 * dims))

    groups = _groups(rows, row_block, anchor_block, scratch)
    dealt = rows.join(sent_whole(groups, F.lit(64)), "label")

    def blocks(df: DataFrame, count: str, name: str) -> tuple[DataFrame, int]:
        packed = (df.withColumn("block", F.pmod(F.xxhash64("row"), F.col(count)))
                  .select("grp", "block", "pure", "row", "id", "label", "q").groupBy("grp", "block").applyInArrow(_pack(dims), PACKED))
        return row_index(packed, name=name, with_total=True)

    b, n_b = blocks(dealt, "row_blocks", "b")
    a, n_a = blocks(dealt.where("anchor"), "anchor_blocks", "a")
    a_named, b_named = a.select("a", "grp"), b.select("b", "grp", "pure")

    def meet(anchors: DataFrame, pairs: DataFrame, fn, schema: str) -> DataFrame:
        return (anchors.join(pairs, "a").groupBy("a", "b").cogroup(b.drop("grp", "pure").join(pairs, "b").groupBy("a", "b"))
                .applyInArrow(fn, schema))

    same = scratch.write(a_named.join(b_named, "grp").select("a", "b"), "mining-same")
    by_score = Window.partitionBy("a_row").orderBy(F.desc("p_score"), "p_id", "p_row")
    positives = scratch.write(
        meet(a, same, _positives(dims, primes, n_positives), "a_row long, p_row long, p_id long, p_score long, a long")
        .withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= n_positives), "mining-positives")
    asked = positives.groupBy("a").agg(F.collect_list(F.struct("a_row", "p_row", "p_id", "p_score")).alias("asked"))  # of one block of anchors

    # every block of rows but those of the anchors' own label
    other = scratch.write(
        a_named.select("a", "grp", F.explode(F.sequence(F.lit(0), F.lit(n_b - 1).cast("long"))).alias("b"))
        .join(b_named.select("b", F.col("grp").alias("b_grp"), "pure"), "b")
        .where("grp != b_grp or not pure").select("a", "b"), "mining-other")
    found = meet(a.join(asked, "a"), other, _negatives(dims, primes, n_negatives, low, high),
                 "a_row long, a_id long, p_row long, p_id long, p_score long, n_row long, n_id long, n_score long")
    by_score = Window.partitionBy("a_row", "p_row").orderBy(F.desc("n_score"), "n_id", "n_row")
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= n_negatives)
            .select(id_or_null("a_id").alias("anchor_id"), id_or_null("p_id").alias("positive_id"), "rank",
                    id_or_null("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score")))


def oracle(table: str = "embeddings") -> str:
    """The registered query in DuckDB SQL, for tables with unique ids."""
    return f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM {table}
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) <= 3"""
