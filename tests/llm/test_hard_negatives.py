import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, row LONG, id STRING, a INT, q STRING, grp INT"


def brute(rows, every=10, scale=256, n_pos=5, n_neg=3, low=50, high=95):
    last = 2**63 - 1
    kept = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [max(-2**24, min(2**24, math.floor(scale * float(np.float32(x))))) for x in v]
        kept.append((last if i is None else i, y, q))

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    def null(i):
        return None if i == last else i

    out = []
    for k, (i, y, q) in enumerate(kept):
        if i == last or i % every:
            continue
        others = [(dot(q, r), j, z) for m, (j, z, r) in enumerate(kept) if m != k]
        for ps, p, _ in sorted((o for o in others if o[2] == y), key=lambda o: (-o[0], o[1]))[:n_pos]:
            fit = [o for o in others if o[2] != y and low * ps <= 100 * o[0] <= high * ps]
            for rank, (ns, n, _) in enumerate(sorted(fit, key=lambda o: (-o[0], o[1]))[:n_neg], 1):
                out.append((i, null(p), rank, null(n), ps, ns))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "x", 2, "y", 3) for i, v, y in rows], SCHEMA).repartition(3)


def mined(spark, rows, **sizes):
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, dims=16, seed=3):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        y = 0 if rng.random() < 0.4 else rng.randrange(6)   # a hot label
        out.append((i, [c + rng.gauss(0, 1) for c in centre[rng.randrange(6)]], y))
    return out


@pytest.mark.parametrize("sizes", [{}, {"row_block": 40, "anchor_block": 7}])
def test_as_brute_force(spark, sizes):
    rows = vectors(300)
    want = brute(rows)
    assert len(want) > 100
    assert mined(spark, rows, **sizes) == want


def test_odd_rows(spark):
    rows = vectors(60, 4)
    rows += [(60, None, 1), (70, [1.0, None, 0.0, 1.0], 1), (80, [float("nan")] * 4, 1), (90, [float("inf")] * 4, 1), (100, [1.0, 1.0, 1.0, 1.0], None)]
    rows += [(None, [9.0, 9.0, 9.0, 9.0], 0), (None, [-9.0, -9.0, -9.0, -9.0], 0), (None, [0.5, 0.5, 0.5, 0.5], 1), (110, [], 2), (120, [1.0], 2), (130, [0.0] * 4, 3)]
    rows += [(140, [1e30, -1e30, 1.0, 0.0], 2), (141, [1e30, 1.0, 0.0, 0.0], 2), (142, [6e29, 0.0, 0.0, 0.0], 3)]
    rows += [(150, [1.0, 2.0, 3.0, 4.0], 4)] * 3 + [(151 + k, [1.0, 2.0, 3.0, 3.0], 5) for k in range(9)]   # repeated rows, ties
    rows += [(-20, [1.0, 0.0, 1.0, 0.0], 5), (-19, [1.0, 0.1, 1.0, 0.0], 5)]
    want = brute(rows)
    assert mined(spark, rows, row_block=20, anchor_block=5) == want
    assert any(r[1] is None for r in want)
    assert {140, 150} <= {r[0] for r in want}


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (10, None, 0)]) == []
    assert mined(spark, [(10, [1.0], 0), (11, [1.0], 0)]) == []   # no row of another label


@pytest.mark.parametrize("dims, size", [(64, 300), (7, 2**24), (3000, 2**20), (1, 2**24)])
def test_scores_are_exact(dims, size):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-size, size + 1, (9, dims)) for _ in range(2))
    b[:3] = a[:3]
    b[3] = -a[3]
    bound = max(int((x.astype(object) ** 2).sum()) for x in (*a, *b))
    primes = hn.moduli(bound, dims)
    got = hn.scores(hn.residues(a, primes), hn.residues(b, primes), primes)
    assert (got == np.array(a.astype(object) @ b.T.astype(object), dtype=np.int64)).all()


def test_share_is_rounded_right():
    x = np.array([7, -7, 0, 100, -100, 2**62, -(2**62)], dtype=np.int64)
    assert hn.share(x, 50, True).tolist() == [-((-int(v) * 50) // 100) for v in x]
    assert hn.share(x, 95, False).tolist() == [int(v) * 95 // 100 for v in x]
