import hashlib
import math
import random

from pyspark.sql import functions as F

from quarry.operators import lsh

# fixed values: the 50 consecutive primes from 41 that the original exercise expects
PRIMES_FROM_41 = [41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97, 101, 103, 107, 109, 113,
                  127, 131, 137, 139, 149, 151, 157, 163, 167, 173, 179, 181, 191, 193, 197, 199,
                  211, 223, 227, 229, 233, 239, 241, 251, 257, 263, 269, 271, 277, 281, 283, 293]


def test_next_primes(spark):
    got = [r.p for r in lsh.next_primes(spark, 50, 41).orderBy("i").collect()]
    assert got == PRIMES_FROM_41
    assert [r.p for r in lsh.next_primes(spark, 3, 1).orderBy("i").collect()] == [2, 3, 5]


def test_primes_in_column(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    got = sorted(r.k for r in lsh.primes_in(df, "k").collect())
    want = [v for v in range(500) if v >= 2 and all(v % d for d in range(2, math.isqrt(v) + 1))]
    assert got == want


def test_single_hash_and_family_goldens(spark):
    # h(x) = (a x + b) % p with a, b drawn from Python's RNG seeded 123
    a, b = lsh.draw_ab(123, 1, 12)[0]
    df = spark.createDataFrame([(99,)], "x LONG")
    assert lsh.hash_column(df, "x", a, b, 7).first()["h"] == 6
    fam = lsh.hash_family(spark, 123, 10, 150)
    _, a7, b7, p7 = fam[7]
    assert lsh.hash_column(df.select(F.lit(32).alias("x")), "x", a7, b7, p7).first()["h"] == 61


def test_decimal_path_no_overflow(spark):
    a, b, p = 3_000_000_019, 7, 4_000_000_007
    df = spark.createDataFrame([(3_999_999_999,)], "x LONG")
    assert lsh.hash_column(df, "x", a, b, p).first()["h"] == (a * 3_999_999_999 + b) % p


def test_band_plan_golden(spark):
    req = spark.createDataFrame([(100, 0.8)], "n LONG, s DOUBLE")
    r = lsh.band_plan(req).first()
    assert (r.b, r.r, r.n_real) == (9, 11, 99)
    assert math.isclose(r.s_real, 0.8189373540396242, rel_tol=1e-12)


def test_signatures_and_buckets_brute_force(spark):
    vecs = {"a": [0, 2, 5], "b": [0, 2, 5], "c": [1, 3], "d": [4], "e": [0, 2, 5, 6]}
    rows = [(e, x) for e, xs in vecs.items() for x in xs]
    inc = spark.createDataFrame(rows, "entity STRING, idx LONG")
    rng = random.Random(7)
    fam = [(i, rng.randint(1, 9), rng.randint(1, 9), p) for i, p in enumerate([11, 13, 17, 19, 23, 29])]
    sig = {r.entity: list(r.sig) for r in lsh.signatures_wide(inc, fam, x_max=6).collect()}
    for e, xs in vecs.items():
        assert sig[e] == [min((a * x + b) % p for x in xs) for _, a, b, p in fam]
    bands = lsh.band_hashes(lsh.signatures_wide(inc, fam, x_max=6), 3, 2)
    got = {(r.band, r.bucket, r.member) for r in lsh.lsh_buckets(bands).collect()}
    want = set()
    for band in range(3):
        key = {e: hashlib.md5(",".join(map(str, s[2 * band:2 * band + 2])).encode()).hexdigest()
               for e, s in sig.items()}
        for e, k in key.items():
            if sum(1 for v in key.values() if v == k) >= 2:
                want.add((band, k, e))
    assert got == want and ("a" in {m for _, _, m in got})


def test_row_index_orders_globally(spark):
    df = spark.createDataFrame([(f"w{i:03d}",) for i in range(200)], "feature STRING").repartition(7)
    from quarry.operators.indexing import row_index

    got = {r.feature: r.idx for r in row_index(df, ["feature"]).collect()}
    assert got == {f"w{i:03d}": i for i in range(200)}


def test_sieve_in_small_segments(spark, monkeypatch):
    monkeypatch.setattr(lsh, "SEGMENT", 7)
    got = sorted(r.p for r in lsh.primes_between(spark, 2, 3000).collect())
    want = [v for v in range(2, 3001) if all(v % d for d in range(2, math.isqrt(v) + 1))]
    assert got == want
    seg = sorted(r.p for r in lsh.primes_between(spark, 2500, 2700).collect())
    assert seg == [v for v in want if 2500 <= v <= 2700]


def test_family_and_apply(spark):
    fam = lsh.hash_family(spark, 123, 3, 20)
    assert [p for *_, p in fam] == [23, 29, 31]
    keys = spark.range(5).withColumnRenamed("id", "x")
    got = {(r.x, r.i): r.h for r in lsh.hash_family_apply(keys, "x", fam).collect()}
    assert got == {(x, i): (a * x + b) % p for x in range(5) for i, a, b, p in fam}


def _sig_buckets(spark, vecs, n_bands=4, n_rows=3):
    rows = [(e, x) for e, xs in vecs.items() for x in xs]
    inc = spark.createDataFrame(rows, "entity STRING, idx LONG")
    fam = lsh.hash_family(spark, 123, n_bands * n_rows, 50)
    sig = lsh.signatures_wide(inc, fam, x_max=50)
    return lsh.lsh_buckets(lsh.band_hashes(sig, n_bands, n_rows))


def test_lsh_all_equal_and_none_similar(spark):
    same = {e: [1, 5, 9, 20] for e in "abcde"}
    got = _sig_buckets(spark, same).collect()
    assert {r.band for r in got} == {0, 1, 2, 3}
    assert all(r["size"] == 5 for r in got) and len(got) == 4 * 5
    far = {"a": [0, 1, 2, 3], "b": [10, 11, 12, 13], "c": [20, 21, 22, 23], "d": [30, 31, 32, 33]}
    assert _sig_buckets(spark, far, n_bands=2, n_rows=6).count() == 0


def test_band_plan_rounds_down_to_whole_bands(spark):
    req = spark.createDataFrame([(10, 0.5), (7, 0.9), (50, 0.2)], "n LONG, s DOUBLE")
    for r in lsh.band_plan(req).collect():
        x = -r.n * math.log(r.s)
        assert 1 <= r.b <= r.n and r.b * math.log(r.b) <= x
        assert r.b == r.n or (r.b + 1) * math.log(r.b + 1) > x
        assert r.r == r.n // r.b and r.n_real == r.r * r.b <= r.n
        assert math.isclose(r.s_real, (1 / r.b) ** (1 / r.r))


def test_row_index_many_partitions(spark):
    from quarry.operators.indexing import row_index

    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    got = row_index(df, ["k"], "pos", num_partitions=300).orderBy("k").collect()
    assert [r.pos for r in got] == list(range(len(got))) and [r.k for r in got] == list(range(0, 5000, 3))


def test_hash_expr_all_arithmetic_paths(spark):
    xs = [0, 1, 12345, (1 << 20) - 1, 1 << 20, 987654321012, (1 << 40) - 1]
    df = spark.createDataFrame([(x,) for x in xs], "x LONG")
    cases = [
        (12, 5, 7, 100),                                 # plain long
        (1_099_511_627_000, 1_000_000_007, 1_099_511_627_689, (1 << 40) - 1),  # 20-bit split
        (3_000_000_019_000, 7, 4_000_000_007_001, (1 << 40) - 1),              # decimal
    ]
    for a, b, p, x_max in cases:
        got = [r.h for r in df.select(lsh.hash_expr("x", a, b, p, x_max).alias("h")).collect()]
        assert got == [(a * x + b) % p for x in xs], (a, b, p)


def test_sieve_segment_far_from_zero(spark):
    lo, hi = 10**9 + 7, 10**9 + 3000
    got = sorted(r.p for r in lsh.primes_between(spark, lo, hi).collect())
    want = [v for v in range(lo, hi + 1) if all(v % d for d in range(2, math.isqrt(v) + 1))]
    assert got == want and len(want) > 100


def test_prime_keys_far_apart(spark):
    """A handful of keys between 2 and 2^63: the work follows the keys."""
    primes = [2, 3, 37, 41, 1369 + 4, 1_000_003, 2_147_483_647, 3_037_000_493, 999_999_999_989, 9_223_372_036_854_775_783]
    others = [-7, 0, 1, 4, 1369, 1681, 25_326_001, 3_215_031_751, 1_000_003 * 1_000_003, 2_147_483_647 * 2_147_483_629,
              3_825_123_056_546_413_051, 9_223_372_036_854_775_807]
    df = spark.createDataFrame([(v,) for v in primes + others] + [(None,)], "k LONG")
    assert sorted(r.k for r in lsh.primes_in(df, "k").collect()) == sorted(primes)
    got = [r.id for r in lsh.primes_in(spark.range(0, 20000), "id").collect()]
    assert sorted(got) == [v for v in range(2, 20000) if all(v % d for d in range(2, math.isqrt(v) + 1))]


def test_hash_plans_have_no_decimal(spark):
    from quarry.plans.queries import QUERIES

    for name in ("hash_column", "hash_family_apply"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "decimal" not in plan


def test_band_plan_without_a_valid_threshold(spark):
    df = spark.createDataFrame([(10, 1.5), (10, 0.0), (0, 0.5), (10, 1.0), (100, 0.8)], "n LONG, s DOUBLE")
    got = {(r.n, r.s): (r.b, r.r) for r in lsh.band_plan(df).collect()}
    assert got[(10, 1.5)] == got[(10, 0.0)] == got[(0, 0.5)] == (None, None)
    assert got[(10, 1.0)] == (1, 10) and got[(100, 0.8)] == (9, 11)


def _primes(lo, hi):
    return [v for v in range(max(lo, 2), hi + 1) if all(v % d for d in range(2, int(v**0.5) + 1))]


def test_sieve_of_segments(spark, monkeypatch):
    from quarry.operators import lsh as mod

    for lo, hi in ((0, 100), (2, 2), (3, 2), (90, 97), (9973, 10200), (121, 169), (10**6, 10**6 + 200)):
        assert mod.sieve(lo, hi).tolist() == _primes(lo, hi)
    assert mod.sieve(10**12, 10**12 + 100).tolist() == [10**12 + d for d in (39, 61, 63, 91)]
    monkeypatch.setattr(mod, "SEGMENT", 50)
    monkeypatch.setattr(mod, "BASE_PART", 7)
    assert mod.sieve(5000, 5200).tolist() == _primes(5000, 5200)
    assert sorted(r.p for r in mod.primes_between(spark, 80, 3000).collect()) == _primes(80, 3000)


def test_primes_from_starts(spark):
    starts = [None, -5, 0, 2, 3, 8, 8, 8, 113, 114, 10**6, lsh.SEGMENT - 1, lsh.SEGMENT, 10**9]
    df = spark.createDataFrame([(s,) for s in starts], "c LONG")
    got = {}
    for r in lsh.primes_from(df, "c", 3).collect():
        got.setdefault(r.start, {})[r.i] = r.p
    assert set(got) == {max(s, 2) for s in starts if s is not None}
    for s, ps in got.items():
        assert [ps[i] for i in range(3)] == _primes(s, s + 400)[:3]
    assert lsh.primes_from(df.where("false"), "c", 3).count() == 0


def test_band_plan_for_very_many_functions(spark):
    import math

    rows = [(n, s) for n in (1, 2, 3, 1000, 10**6, 10**9, 10**12) for s in (1e-300, 0.001, 0.5, 0.8, 0.999999, 1.0)]
    for r in lsh.band_plan(spark.createDataFrame(rows + [(None, 0.5), (0, 0.5), (5, 0.0), (5, 1.5)], "n LONG, s DOUBLE")).collect():
        if r.n is None or r.n < 1 or not 0 < r.s <= 1:
            assert r.b is None
            continue
        limit = -r.n * math.log(r.s)
        slack = 1e-9 * max(1.0, limit)
        assert 1 <= r.b <= r.n and r.b * math.log(r.b) <= limit + slack
        assert r.b == r.n or (r.b + 1) * math.log(r.b + 1) > limit - slack
        assert r.r == r.n // r.b and r.n_real == r.r * r.b


def test_many_features_meet_their_index_by_key(spark):
    rows = [(e, f"w{(e * 7 + j * j) % 61}") for e in range(40) for j in range(9)] + [(3, None)]
    inc = spark.createDataFrame(rows, "entity LONG, feature STRING")
    small = lsh.minhash_lsh(inc, ["feature"], 123, 4, 3)
    large = lsh.minhash_lsh(inc, ["feature"], 123, 4, 3, broadcast_rows=1)
    assert {(r.entity, *r.sig) for r in small[0].collect()} == {(r.entity, *r.sig) for r in large[0].collect()}
    assert {tuple(r) for r in small[2].collect()} == {tuple(r) for r in large[2].collect()}
    plan = large[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "Rebalance" in plan  # no text in the join, pairs dealt by entity


def test_feature_keys_of_a_seed_without_collisions(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lsh, "feature_key", lambda s: F.pmod(F.xxhash64(F.lit(s), F.col("feature")), F.lit(8)).alias("key"))
    idx = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3), (None, 4)], "feature STRING, idx LONG")
    keyed, seed = lsh.keyed_index(idx)
    got = [r.key for r in keyed.collect()]
    assert len(got) == 4 and len(set(got)) == 4 and seed >= 0


def test_band_rows_are_not_kept_as_row_checkpoints(spark, tmp_dir):
    import glob

    from quarry.session import scratch_dir

    inc = spark.createDataFrame([(e, f"w{j}") for e in range(5) for j in range(4)], "entity LONG, feature STRING")
    before = set(glob.glob(f"{scratch_dir(spark).removeprefix('file:')}/rdd-*"))
    assert lsh.minhash_lsh(inc, ["feature"], 123, 2, 2, materialize=False)[2].count()
    assert set(glob.glob(f"{scratch_dir(spark).removeprefix('file:')}/rdd-*")) == before
