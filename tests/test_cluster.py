import numpy as np
import pytest

from quarry.operators import cluster as cl
from quarry.operators import incidence as ic

VECS = {
    "a": {1, 2, 3}, "b": {1, 2}, "c": {2, 3}, "d": {7, 8, 9}, "e": {8, 9}, "f": {7, 9, 10},
    "g": {1, 2, 3, 4}, "h": set(),
}


def _inc(spark, vecs=VECS):
    rows = [(e, f) for e, fs in vecs.items() for f in fs]
    return spark.createDataFrame(rows, "entity STRING, feature LONG")


def _dense(vecs):
    feats = sorted(set().union(*vecs.values()))
    return {e: np.array([1.0 if f in fs else 0.0 for f in feats]) for e, fs in vecs.items()}


def _brute_kmeans(vecs, start, max_iter=20):
    x = _dense(vecs)
    names = sorted(x)
    cents = [x[s] for s in start]
    assign = None
    for _ in range(max_iter + 1):
        new = {n: min(range(len(cents)), key=lambda c: (float(((x[n] - cents[c]) ** 2).sum()), c)) for n in names}
        if new == assign:
            break
        assign = new
        for c in range(len(cents)):
            members = [x[n] for n in names if assign[n] == c]
            if members:
                cents[c] = np.mean(members, axis=0)
    return assign


def test_sq_distance_matches_dense(spark):
    inc = _inc(spark)
    pairs = spark.createDataFrame([("a", "b"), ("a", "d"), ("c", "g"), ("a", "h")], "entity1 STRING, entity2 STRING")
    x = _dense(VECS)
    got = {(r.entity1, r.entity2): r.distance for r in ic.sq_distance(inc, pairs).collect()}
    for (p, q), d in got.items():
        assert d == int(((x[p] - x[q]) ** 2).sum())
    assert len(got) == 4


def test_lookup(spark):
    inc = _inc(spark)
    asked = spark.createDataFrame([("a", 1), ("a", 7), ("h", 1)], "entity STRING, feature LONG")
    got = {(r.entity, r.feature): r.present for r in ic.lookup(inc, asked).collect()}
    assert got == {("a", 1): True, ("a", 7): False, ("h", 1): False}


def test_from_baskets_tests_items_only(spark):
    b = spark.createDataFrame([("ab", ["ab", "cd"]), ("zz", ["cd"])], "plant STRING, items ARRAY<STRING>")
    got = sorted((r.entity, r.feature) for r in ic.from_baskets(b, "plant", "items").collect())
    assert got == [("ab", "ab"), ("cd", "ab"), ("cd", "zz")]


def test_kmeans_matches_brute_force(spark):
    inc = _inc(spark, {k: v for k, v in VECS.items() if v})
    start = cl.init_centroids(inc, 2, chosen=["a", "d"])
    a, passes, moved = cl.kmeans(inc, start)
    assert moved == 0
    got = {r.entity: r.cluster for r in a.collect()}
    want = _brute_kmeans({k: v for k, v in VECS.items() if v}, ["a", "d"])
    assert got == want and passes >= 1


def test_kmeans_keeps_emptied_cluster(spark):
    vecs = {"a": {1}, "b": {1}, "c": {5}}
    inc = _inc(spark, vecs)
    # "a" and "b" are equal; both start centroids are equal vectors, ties go to cluster 0
    start = cl.init_centroids(inc, 3, chosen=["a", "b", "c"])
    a, *_ = cl.kmeans(inc, start)
    got = {r.entity: r.cluster for r in a.collect()}
    assert got == {"a": 0, "b": 0, "c": 2}


def test_first_iter_and_seeded_init(spark):
    inc = _inc(spark)
    s1 = [r.entity for r in cl.init_centroids(inc, 3, seed=123).collect()]
    s2 = [r.entity for r in cl.init_centroids(inc.repartition(3), 3, seed=123).collect()]
    assert s1 == s2 and len(set(s1)) == 3
    fi = {r.member: r.centroid for r in cl.first_iter(inc, cl.init_centroids(inc, 2, chosen=["a", "d"])).collect()}
    assert fi["b"] == "a" and fi["e"] == "d"


def test_valued_kmeans_matches_numpy(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 0.3, (8, 3)), rng.normal(3, 0.3, (8, 3)), rng.normal([0, 4, 0], 0.3, (8, 3))])
    names = [f"p{i:02d}" for i in range(len(pts))]
    rows = [(n, j, float(v)) for n, p in zip(names, pts) for j, v in enumerate(p)]
    inc = spark.createDataFrame(rows, "entity STRING, feature INT, value DOUBLE")
    start = ["p00", "p01", "p08"]
    a, *_ = cl.kmeans(inc, cl.init_centroids(inc, 3, chosen=start), value="value")
    got = {r.entity: r.cluster for r in a.collect()}
    x = dict(zip(names, pts))
    cents = [x[s] for s in sorted(start)]
    assign = None
    for _ in range(11):
        new = {n: min(range(3), key=lambda c: (float(((x[n] - cents[c]) ** 2).sum()), c)) for n in names}
        if new == assign:
            break
        assign = new
        cents = [np.mean([x[n] for n in names if assign[n] == c], axis=0) if any(assign[n] == c for n in names)
                 else cents[c] for c in range(3)]
    assert got == assign


def test_kmeans_shuffle_path_equals_broadcast_path(spark):
    inc = _inc(spark, {k: v for k, v in VECS.items() if v})
    start = cl.init_centroids(inc, 2, chosen=["a", "d"])
    a1, *_ = cl.kmeans(inc, start)
    a2, *_ = cl.kmeans(inc, start, broadcast_rows=0)
    assert {r.entity: r.cluster for r in a1.collect()} == {r.entity: r.cluster for r in a2.collect()}


def test_kmeans_stops_at_max_iter(spark):
    inc = _inc(spark, {k: v for k, v in VECS.items() if v})
    start = cl.init_centroids(inc, 3, chosen=["a", "b", "c"])
    _, passes, moved = cl.kmeans(inc, start, max_iter=1)
    assert passes == 1 and moved >= 0


def test_featureless_entity_is_placed(spark):
    inc = _inc(spark)  # "h" has no feature rows
    ents = spark.createDataFrame([(e,) for e in VECS], "entity STRING")
    start = cl.init_centroids(inc, 2, chosen=["a", "d"])
    a, *_ = cl.kmeans(inc, start, entities=ents)
    got = {r.entity: r.cluster for r in a.collect()}
    want = _brute_kmeans(VECS, ["a", "d"])
    assert got == want and "h" in got
    fi = {r.member: r.centroid for r in cl.first_iter(inc, start, entities=ents).collect()}
    assert "h" in fi


@pytest.mark.parametrize("value", [None, "value"])
def test_grouped_clusters_equal_one_aggregate(spark, monkeypatch, value):
    rng = np.random.default_rng(11)
    if value:
        rows = [(f"e{i}", j, float(v)) for i in range(30) for j, v in enumerate(rng.normal(size=4))]
        inc = spark.createDataFrame(rows, "entity STRING, feature INT, value DOUBLE")
    else:
        rows = [(f"e{i}", int(f)) for i in range(30) for f in rng.choice(12, size=rng.integers(0, 6), replace=False)]
        inc = spark.createDataFrame(rows, "entity STRING, feature LONG")
    ents = spark.createDataFrame([(f"e{i}",) for i in range(30)], "entity STRING")
    start = cl.init_centroids(ents, 6, seed=5)
    wide, *_ = cl.kmeans(inc, start, value=value, entities=ents)
    want = {r.entity: r.cluster for r in wide.collect()}
    monkeypatch.setattr(cl, "GROUP", 2)
    long_, *_ = cl.kmeans(inc, start, value=value, entities=ents)
    assert {r.entity: r.cluster for r in long_.collect()} == want


def test_equal_distance_goes_to_smaller_cluster(spark):
    """Five features, two clusters exactly 4 away: the sums give 4.0 and 3.9999999999999996."""
    nx = spark.createDataFrame([("x", 5)], "entity STRING, nx LONG")
    inc = spark.createDataFrame([("x", f) for f in range(5)], "entity STRING, feature INT")
    cnt = spark.createDataFrame([(0, f, c) for f, c in enumerate((2, 2, 2, 1, 1))] + [(1, f, c) for f, c in enumerate((2, 2, 1, 1, 1))],
                                "cluster INT, feature INT, cnt LONG")
    row = cl.assign(inc, nx, cnt, {0: (12, 48), 1: (3, 33)}).first()
    assert (row.cluster, row.dist) == (0, 4.0)


def test_result_has_no_move_left(spark):
    rng = np.random.default_rng(3)
    vecs = {f"e{i:02d}": set(rng.choice(15, size=rng.integers(1, 7), replace=False).tolist()) for i in range(60)}
    a, passes, moved = cl.kmeans(_inc(spark, vecs), cl.init_centroids(_inc(spark, vecs), 4, seed=2))
    got = {r.entity: r.cluster for r in a.collect()}
    x = _dense(vecs)
    cents = {c: np.mean([x[e] for e in got if got[e] == c], axis=0) for c in set(got.values())}
    for e, c in got.items():
        best = min((round(float(((x[e] - m) ** 2).sum()), 9), k) for k, m in cents.items())
        assert best[1] == c
    assert moved == 0 and passes > 1


@pytest.mark.parametrize("value", [None, "value"])
def test_bounded_passes_equal_joined_passes(spark, monkeypatch, value):
    """Many passes, a cut every second one, blocks of few values."""
    from quarry.operators import lloyd

    monkeypatch.setattr(lloyd, "CUT", 2)
    rng = np.random.default_rng(8)
    if value:
        rows = [(i, j, float(v)) for i in range(150) for j, v in enumerate(rng.normal(size=5)) if j or i % 3]
        inc = spark.createDataFrame(rows, "entity LONG, feature INT, value DOUBLE")
    else:
        rows = [(i, f"f{f}") for i in range(150) for f in rng.choice(14, size=rng.integers(0, 8), replace=False)]
        inc = spark.createDataFrame(rows, "entity LONG, feature STRING")
    ents = spark.range(151).toDF("entity")
    start = cl.init_centroids(ents.where("entity < 150"), 7, seed=4)
    bound = cl.kmeans(inc, start, value=value, entities=ents)
    joined = cl.kmeans(inc, start, value=value, entities=ents, broadcast_rows=0)
    assert bound.moved == joined.moved == 0 and bound.passes == joined.passes > 4
    a, b = ({r.entity: (r.cluster, r.dist) for r in x.assignment.collect()} for x in (bound, joined))
    assert len(a) == 151 and a.keys() == b.keys()
    assert all(a[e][0] == b[e][0] and abs(a[e][1] - b[e][1]) < 1e-8 for e in a)
    stopped = cl.kmeans(inc, start, value=value, entities=ents, max_iter=2)
    assert stopped.passes == 2 and stopped.moved > 0


def test_bounds_spare_measurements(monkeypatch):
    """Far clusters: after the first pass hardly any entity is measured again, and moved ones alone change the sums."""
    from quarry.operators import lloyd

    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(c, 0.1, (50, 2)) for c in (0, 10, 20)])
    block = dict(zip(lloyd._FIELDS, ((pts ** 2).sum(axis=1), np.tile(np.arange(2, dtype=np.int32), 150), pts.ravel(),
                                     np.arange(0, 301, 2), np.full(150, -1, dtype=np.int32), np.zeros(150), np.zeros(150))))
    measured = []
    real = lloyd.Centres.distances
    monkeypatch.setattr(lloyd.Centres, "distances", lambda self, b, rows: measured.append(len(rows)) or real(self, b, rows))
    import pyarrow as pa

    def batch(x):
        return pa.RecordBatch.from_arrays([pa.array([list(range(150))]), *(pa.array([np.ascontiguousarray(x[f], dtype=t).tobytes()], pa.binary())
                                                                        for f, t in lloyd._KINDS.items())], ["entity", *lloyd._FIELDS])
    first = lloyd.Centres(pts[[0, 50, 100]].T.copy(), np.ones(3))
    out = next(lloyd._assign(first, None, True)([batch(block)]))
    state = lloyd._read(out, 0)
    assert state["cluster"].tolist() == [0] * 50 + [1] * 50 + [2] * 50 and measured == [150]
    sums = np.zeros(2 * 3 + 4)
    sums[out.column("keys")[0].as_py()] = out.column("sums")[0].as_py()
    assert sums[6:].tolist() == [50, 50, 50, 150]
    assert np.allclose(sums[:6].reshape(2, 3).T, [pts[i: i + 50].sum(axis=0) for i in (0, 50, 100)])
    new = lloyd.Centres(sums[:6].reshape(2, 3), sums[6:9])
    shift = np.sqrt(((new.sums / new.sizes - first.sums / first.sizes) ** 2).sum(axis=0))
    out = next(lloyd._assign(new, shift, False)([batch(state)]))
    assert measured == [150] and out.column("keys")[0].as_py() == [9] and out.column("sums")[0].as_py() == [0.0]


def test_full_passes_are_few_and_decided_entities_stay_out(spark, monkeypatch):
    """Every pass went over all vectors before."""
    from quarry.operators import lloyd

    full, kept = [], []
    assign, dealt = lloyd._assign, lloyd._dealt

    def held(*a):
        vectors = dealt(*a)
        kept.append(vectors.map(lambda b: len(b["nx"])).sum())
        return vectors

    monkeypatch.setattr(lloyd, "CUT", 6)
    monkeypatch.setattr(lloyd, "_assign", lambda *a: full.append(1) or assign(*a))
    monkeypatch.setattr(lloyd, "_dealt", held)
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (500, 3)), rng.normal(1000, 0.1, (100, 3))])
    inc = spark.createDataFrame([(i, j, float(v)) for i, p in enumerate(pts) for j, v in enumerate(p)], "entity LONG, feature INT, value DOUBLE")
    chosen = [1, 2, 3, 4, 5, 550]
    found = cl.kmeans(inc, cl.init_centroids(inc, 6, chosen=chosen), value="value")
    cents, want, passes = pts[chosen], None, -1
    while True:
        new = ((pts[:, None] - cents) ** 2).sum(axis=2).argmin(axis=1)
        passes += 1
        if want is not None and (new == want).all():
            break
        want = new
        cents = np.array([pts[want == c].mean(axis=0) for c in range(6)])
    assert {r.entity: r.cluster for r in found.assignment.collect()} == dict(enumerate(want.tolist()))
    assert found.passes == passes > 20 and found.moved == 0
    assert len(full) * 2 <= passes and min(kept) <= 500 < len(pts)


def test_sq_distance_over_pages(spark, monkeypatch):
    """Several pages, entities that share none, repeated and unknown entities, sign bits, string features."""
    monkeypatch.setattr(ic, "PAGE", 2)
    rng = np.random.default_rng(6)
    vecs = {f"e{i}": {f"f{f:04d}" for f in rng.choice(700, size=int(rng.integers(0, 500)), replace=False)} for i in range(12)}
    vecs["all"] = {f"f{f:04d}" for f in range(700)}
    inc = _inc(spark, {k: {int(x[1:]) for x in v} for k, v in vecs.items()})
    names = sorted(vecs)
    asked = [(a, b) for a in names for b in names[::3]] + [("e1", "none"), ("none", "none"), ("e1", "e2")]
    pairs = spark.createDataFrame(asked, "entity1 STRING, entity2 STRING")
    for table in (inc, inc.unionByName(inc), inc.withColumn("feature", inc["feature"].cast("string"))):
        got = ic.sq_distance(table, pairs).collect()
        assert len(got) == len(set(asked))
        for r in got:
            assert r.distance == len(vecs.get(r.entity1, set()) ^ vecs.get(r.entity2, set()))
