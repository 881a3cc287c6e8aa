"""Primes, universal hashing, min-hash signatures and LSH banding.

Design
------
* Primes come from a segmented sieve: a task strikes the multiples of the
  primes up to ``sqrt(hi)`` from the bit set of its segment. Segments are
  independent, so a range is a map, and starts from a table are dealt to the
  segments they lie in.
* A hash family is ``n`` tuples ``(i, a, b, p)``: ``a`` and ``b`` drawn on the
  driver with Python's seeded ``random.randint(1, m)`` (``a`` before ``b``,
  function by function), ``p`` the ``i``-th prime ``>= m``. ``n`` is a
  parameter, so the family is a handful of literals.
* Signatures are ONE aggregation keyed by entity holding ``n`` ``min``
  expressions over ``(a*x+b) % p`` -- no incidence x family product; the
  partial aggregate keeps one row per entity per map task, so even an entity
  holding a third of all rows costs one row per task in the shuffle.
* Band hashes are ``md5`` of the comma-joined band slice. Buckets are found by
  counting ``(band, bucket)`` (partial aggregate) and joining the buckets
  with two or more members back: members stay in long form, never collected
  into one array, so a huge bucket is never held by one task.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.operators.indexing import row_index
from quarry.session import BROADCAST_ROWS, bounded_side, drop_written, release_unused, ship_package, written_table

LONG_SAFE = (1 << 63) - 1


# ----------------------------------------------------------------- primes
SEGMENT = 1 << 22   # numbers of a segment, one bit set of a task
BASE_PART = 1 << 22 # numbers among which base primes are found at a time


def _strike(alive: np.ndarray, lo: int, base: np.ndarray) -> None:
    """Clear the multiples, from their squares on, of some primes in ``alive``, which starts at ``lo``."""
    hi = lo + len(alive)
    for q in base.tolist():
        if q * q >= hi:
            break
        alive[max(q * q, -(-lo // q) * q) - lo:: q] = False


def sieve(lo: int, hi: int) -> np.ndarray:
    """Primes in ``[lo, hi]``: a bit set struck by all primes up to ``sqrt(hi)``, which are
    themselves sieved part by part, so memory follows the segment and ``BASE_PART``."""
    lo = max(lo, 2)
    if hi < lo:
        return np.zeros(0, dtype=np.int64)
    alive = np.ones(hi - lo + 1, dtype=bool)
    root = math.isqrt(hi)
    for at in range(2, root + 1, BASE_PART):
        _strike(alive, lo, sieve(at, min(root, at + BASE_PART - 1)))
    return np.flatnonzero(alive) + lo


def _segments(lo: int, hi: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(sieve(max(lo, k * SEGMENT), min(hi, (k + 1) * SEGMENT - 1)), pa.int64())], ["p"])
    return run


def primes_between(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """``(p)``: all primes in ``[lo, hi]``, a segment at a time in every task; nothing is shuffled."""
    lo = max(lo, 2)
    if hi < lo:
        return spark.range(0).select(F.col("id").alias("p"))
    ship_package(spark)
    first, last = lo // SEGMENT, hi // SEGMENT
    n_part = min(last - first + 1, 64 * spark.sparkContext.defaultParallelism)
    return spark.range(first, last + 1, 1, n_part).mapInArrow(_segments(lo, hi), "p long")


def _following(n: int):
    def run(starts: pa.Table) -> pa.Table:
        start = np.unique(starts["start"].to_numpy())
        last, primes, end = int(start[-1]), np.zeros(0, dtype=np.int64), int(start[0]) - 1
        step = max(64, int(2 * n * math.log(last + n)))   # about twice the gap of n primes
        while len(primes) - np.searchsorted(primes, last) < n:
            upto = max(end, last) + step
            primes = np.concatenate([primes, sieve(end + 1, upto)])
            end = upto
        place = np.searchsorted(primes, start)[:, None] + np.arange(n)[None, :]
        return pa.table({"start": np.repeat(start, n), "i": pa.array(np.tile(np.arange(n), len(start)), pa.int32()), "p": primes[place].ravel()})
    return run


def primes_from(starts: DataFrame, col: str, n: int) -> DataFrame:
    """``(start, i, p)``: the ``n`` smallest primes >= each different value of ``col``; values below 2 start at 2.

    Starts of one segment share a bit set: distinct starts are dealt by segment
    (so a group has at most ``SEGMENT`` of them) and its task sieves on until the
    last start has its primes. Null starts have no rows."""
    ship_package(starts.sparkSession)
    at = F.greatest(F.col(col).cast("long"), F.lit(2).cast("long"))
    return (starts.where(F.col(col).isNotNull()).select(at.alias("start")).distinct()
            .groupBy(F.floor(F.col("start") / SEGMENT).alias("segment")).applyInArrow(_following(n), "start long, i int, p long"))


# fixed values: bases that make Miller-Rabin exact below 3,215,031,751 and below 3.3e24
BASES_32 = (2, 3, 5, 7)
BASES_64 = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
ROOT_63 = 3_037_000_499  # squares of smaller numbers fit a long


def _strong_probable(v: Column, bases: Sequence[int], kind: str, bits: int) -> Column:
    """Whether odd ``v`` passes Miller-Rabin for every base, in arithmetic of type ``kind``."""
    even = v - 1
    twos = F.bit_count(even.bitwiseAND(-even) - 1)            # v - 1 = odd part * 2^twos
    odd = F.call_function("shiftright", even, twos.cast("int"))
    m = v.cast(kind)
    top = (m - 1).cast(kind)

    def times(x, y):
        return ((x * y) % m).cast(kind)

    def passes(a: int) -> Column:
        def step(acc, i):
            sq = times(acc, acc)
            bit = F.call_function("shiftright", odd, i).bitwiseAND(F.lit(1).cast("long"))
            return F.when(bit == 1, times(sq, F.lit(a).cast(kind))).otherwise(sq)

        power = F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), F.lit(1).cast(kind), step)
        first = F.struct(power.alias("x"), F.lit(False).alias("ok"))

        def square(acc, r):
            return F.struct(times(acc["x"], acc["x"]).alias("x"),
                            (acc["ok"] | ((r <= twos) & (acc["x"] == top)) | ((r == 1) & (acc["x"] == 1))).alias("ok"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(bits)), first, square)["ok"]

    out = passes(bases[0])
    for a in bases[1:]:
        out = out & passes(a)
    return out


def is_prime(v: Column) -> Column:
    """Whether a long is prime: exact Miller-Rabin, the same bounded work for every value."""
    small = v.isin(*BASES_64)
    factor = F.lit(False)
    for q in BASES_64:
        factor = factor | (v % q == 0)
    return (F.when(v < 2, F.lit(False)).when(small, F.lit(True)).when(factor, F.lit(False))
            .when(v < 37 * 37, F.lit(True))
            .when(v < min(ROOT_63, 3_215_031_751), _strong_probable(v, BASES_32, "long", 32))
            .otherwise(_strong_probable(v, BASES_64, "decimal(38,0)", 63)))


def primes_in(df: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose integer ``col`` is prime.

    A filter: the work follows the rows, not the range that their keys span,
    and nothing is shuffled."""
    return df.where(is_prime(F.col(col).cast("long")))


def next_primes(spark: SparkSession, n: int, c: int) -> DataFrame:
    """``(i, p)``: the ``n`` smallest primes ``>= c`` (``i`` from 0).

    The window ``[c, c + w)`` starts at about ``n * ln(c)`` (prime gaps
    average ``ln c``) and doubles until it holds ``n`` primes.
    """
    c = max(int(c), 2)
    w = max(64, int(1.5 * n * math.log(c + n)) + 16)
    while True:
        ps = primes_between(spark, c, c + w - 1)
        if ps.count() >= n:
            break
        w *= 2
    top = ps.orderBy("p").limit(n)
    # at most n rows reach this window
    return top.select((F.row_number().over(Window.orderBy("p")) - 1).cast("int").alias("i"), "p")


# ----------------------------------------------------------------- hashing
def draw_ab(seed: int, n: int, m: int) -> list[tuple[int, int]]:
    """``n`` pairs ``(a, b)`` from Python's RNG seeded with ``seed``, both in ``1..m``."""
    rng = random.Random(seed)
    return [(rng.randint(1, m), rng.randint(1, m)) for _ in range(n)]


def hash_family(spark: SparkSession, seed: int, n: int, m: int) -> list[tuple[int, int, int, int]]:
    """``[(i, a, b, p)]``: the ``i``-th prime ``>= m`` with seeded ``a``, ``b``.

    ``n`` rows (a parameter) reach the driver.
    """
    m = max(int(m), 1)
    ps = [r["p"] for r in next_primes(spark, n, m).orderBy("i").collect()]
    ab = draw_ab(seed, n, m)
    return [(i, a, b, p) for i, ((a, b), p) in enumerate(zip(ab, ps))]


SPLIT = 1 << 20
SPLIT_LIMIT = 1 << 40


def hash_expr(x, a: int, b: int, p: int, x_max: int | None = None) -> Column:
    """``(a * x + b) % p`` exactly, in the cheapest arithmetic that cannot overflow.

    * ``a * x_max + b`` fits a long: plain long arithmetic;
    * ``a, b, p, x_max < 2^40`` (about 10^12 features): ``x`` is split into
      two 20-bit halves, ``((a * x_hi % p) * 2^20 + a * x_lo + b) % p``, every
      intermediate below 2^62;
    * otherwise decimal(38, 0).
    """
    x = F.col(x) if isinstance(x, str) else x
    if x_max is not None and a * x_max + b <= LONG_SAFE:
        return (F.lit(a) * x.cast("long") + F.lit(b)) % F.lit(p)
    if x_max is not None and max(a, b, p, x_max + 1) <= SPLIT_LIMIT:
        xl = x.cast("long")
        hi = F.shiftright(xl, 20)
        lo = xl.bitwiseAND(F.lit(SPLIT - 1))
        return (((F.lit(a) * hi) % F.lit(p)) * F.lit(SPLIT) + F.lit(a) * lo + F.lit(b)) % F.lit(p)
    d = "decimal(38,0)"
    return ((F.lit(a).cast(d) * x.cast(d) + F.lit(b).cast(d)) % F.lit(p).cast(d)).cast("long")


def hash_column(df: DataFrame, col: str, a: int, b: int, p: int, name: str = "h",
                x_max: int | None = None) -> DataFrame:
    return df.withColumn(name, hash_expr(col, a, b, p, x_max))


def hash_family_apply(df: DataFrame, col: str, family, x_max: int | None = None) -> DataFrame:
    """``(..., i, h)``: every key hashed by every function (``n`` rows per key)."""
    arr = F.array(*[F.struct(F.lit(i).alias("i"), hash_expr(col, a, b, p, x_max).alias("h"))
                    for i, a, b, p in family])
    return df.select("*", F.inline(arr))


# ----------------------------------------------------------------- min-hash
def signatures_wide(inc: DataFrame, family, x_max: int | None = None,
                    entity: str = "entity", idx: str = "idx") -> DataFrame:
    """``(entity, sig)``: ``sig[i]`` = min over the entity's feature indexes of ``h_i``."""
    mins = [F.min(hash_expr(idx, a, b, p, x_max)).alias(f"h{i}") for i, a, b, p in family]
    g = inc.groupBy(entity).agg(*mins)
    return g.select(entity, F.array(*[F.col(f"h{i}") for i, *_ in family]).alias("sig"))


def signatures_long(sig: DataFrame, entity: str = "entity") -> DataFrame:
    """``(entity, i, h)`` view of a wide signature."""
    return sig.select(entity, F.posexplode("sig").alias("i", "h"))


def band_hashes(sig: DataFrame, n_bands: int, n_rows: int, entity: str = "entity") -> DataFrame:
    """``(entity, band, bucket)``: md5 of ``sig[b*r : (b+1)*r]`` joined by commas."""
    bands = [F.md5(F.array_join(F.slice("sig", bnd * n_rows + 1, n_rows).cast("array<string>"), ","))
             for bnd in range(n_bands)]
    return sig.select(entity, F.posexplode(F.array(*bands)).alias("band", "bucket"))


def band_hash(sig: DataFrame, band: int, n_rows: int, entity: str = "entity") -> DataFrame:
    """One band of every entity: ``(entity, bucket)``."""
    sl = F.slice("sig", band * n_rows + 1, n_rows).cast("array<string>")
    return sig.select(entity, F.md5(F.array_join(sl, ",")).alias("bucket"))


def lsh_buckets(bands: DataFrame, min_size: int = 2, entity: str = "entity") -> DataFrame:
    """``(band, bucket, member, size)`` for buckets with at least ``min_size`` members.

    ``bands`` is read twice (bucket sizes, then the join back); it is
    written once (entities x bands rows) so the signature aggregate
    behind it runs once.
    """
    bands = written_table(bands, "bands")
    release_unused(bands.sparkSession)
    # written before it is joined: above an aggregate on the join key a hot bucket isn't split
    sizes = written_table(bands.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size"))
                          .where(F.col("size") >= min_size), "bucket-sizes")
    return bands.join(sizes, ["band", "bucket"]).select(
        "band", "bucket", F.col(entity).alias("member"), "size")


def keyed_index(idx: DataFrame) -> tuple[DataFrame, int]:
    """``(key, idx)``, a 64-bit key for every text feature but null, and the seed of the keys.

    Seeds are tried until no two features share a key, so a join on keys is a join on features."""
    seed = 0
    while True:
        keyed = written_table(idx.where(F.col("feature").isNotNull()).select(feature_key(seed), "idx"), "feature-keys")
        if not keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            return keyed, seed
        drop_written(keyed)
        seed += 1


def feature_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("feature")).alias("key")


def minhash_lsh(inc: DataFrame, feature_order: Sequence[str], seed: int, n_bands: int,
                n_rows: int, m: int | None = None, features: DataFrame | None = None,
                materialize: bool = True, broadcast_rows: int = BROADCAST_ROWS):
    """Signatures and banded buckets for ``inc(entity, feature)``.

    Feature index = 0-based rank in ``feature_order`` over ``features`` (all
    known features; defaults to those in ``inc``); ``m`` defaults to the
    number of features, as the original used the number of input lines.
    ``inc`` may repeat a pair: a repeat cannot change a minimum.
    ``inc`` is read twice (feature index, signatures). With ``materialize``
    it is written once to the shared folder. Pass ``False`` when ``inc`` is
    cheaper to derive than to store, as shingles are: each holds three words.

    Up to ``broadcast_rows`` features, the index goes to every task. Above it,
    text features meet their index by 64-bit keys (``keyed_index``), so that no
    text is shuffled for the join, and the pairs (entity, index) are dealt by
    entity before the minima are taken: in the order of the join, a task has few
    features of every entity, and a row of ``n_bands * n_rows`` minima for each
    is many times the pairs. Adaptive execution splits an entity with very many.
    Returns ``(signature_wide, bands, buckets)``.
    """
    spark = inc.sparkSession
    if materialize:
        inc = written_table(inc, "incidence")
    feats = features if features is not None else inc.select("feature").distinct()
    idx, total = row_index(feats.select("feature", *[c for c in feature_order if c != "feature"]),
                           feature_order, with_total=True)
    release_unused(spark)
    m = m if m is not None else total
    family = hash_family(spark, seed, n_bands * n_rows, m)
    x_max = max(m - 1, 0)
    if total <= broadcast_rows:
        inc_i = inc.join(bounded_side(idx.select("feature", "idx"), total), "feature")
    else:
        if isinstance(inc.schema["feature"].dataType, StringType):
            keyed, key_seed = keyed_index(idx)
            drop_written(idx)
            pairs = inc.where(F.col("feature").isNotNull()).select("entity", feature_key(key_seed)).join(keyed.hint("merge"), "key")
        else:
            pairs = inc.join(idx.select("feature", "idx").hint("merge"), "feature")
        inc_i = pairs.select("entity", "idx").hint("rebalance", "entity")
    sig = signatures_wide(inc_i, family, x_max)
    bands = band_hashes(sig, n_bands, n_rows)
    return sig, bands, lsh_buckets(bands)


# ----------------------------------------------------------------- band plan
def band_plan(requests: DataFrame, n: str = "n", s: str = "s") -> DataFrame:
    """Bands ``b`` and rows ``r`` for ``n`` hash functions and threshold ``s``.

    ``b`` is the largest integer in ``[1, n]`` with ``b * ln b <= -n * ln s``,
    i.e. ``floor(exp(W(-n ln s)))`` without a Lambert-W; then ``r = n div b``,
    ``n_real = r * b`` and ``s_real = (1/b)^(1/r)``. ``b * ln b`` rises with
    ``b``, so each row bisects ``[1, n]``, a step for each bit of ``n``; no join,
    no shuffle. Rows without a threshold in (0, 1] or without a hash function
    have no plan and give nulls.
    """
    valid = (F.col(n) >= 1) & (F.col(s) > 0) & (F.col(s) <= 1)
    nn, ss = F.when(valid, F.col(n).cast("long")), F.when(valid, F.col(s).cast("double"))
    limit = -nn.cast("double") * F.log(ss)

    def add(limit: Column):
        def step(found: Column, power: Column) -> Column:
            b = found + power
            return F.when((b <= nn) & (b.cast("double") * F.log(b.cast("double")) <= limit), b).otherwise(found)
        return step

    # bit by bit from the highest of n; the limit is bound once, not computed at every step
    powers = F.transform(F.sequence(F.length(F.bin(nn)) - 1, F.lit(0), F.lit(-1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    bcol = F.transform(F.array(limit), lambda x: F.aggregate(powers, F.lit(0).cast("long"), add(x)))[0]
    out = requests.withColumn("b", bcol)
    out = out.withColumn("r", (F.col(n).cast("long") / F.col("b")).cast("long"))
    out = out.withColumn("n_real", F.col("r") * F.col("b"))
    return out.withColumn("s_real", F.pow(F.lit(1.0) / F.col("b"), F.lit(1.0) / F.col("r")))
