"""The file-level functions on small hand-made files, against brute force."""

import csv
import io
import itertools
import math
import os

import pytest

from quarry import api

TREES = [
    ["x", "y", "z", "a", "b", "c", "Nom_parc", "latitude"],
    ["1", "", "", "", "", "", "AHUNTSIC, PARC", "45.1"],
    ["2", "", "", "", "", "", "", "45.2"],
    ["3", "", "", "", "", "", "MONT-ROYAL", "45.3"],
    ["4", "", "", "", "", "", "AHUNTSIC, PARC", "45.4"],
    ["5", "", "", "", "", "", "Prével", "45.5"],
    ["6", "", "", "", "", "", "ZOO", ""],
    ["7", "", "", "", "", "", "MONT-ROYAL", "45.7"],
]
PLANTS = ["abelia,fl,nc", "abies,ak,bc,yt", "acer,fl,nc,ga", "betula,ak,bc,yt,nc",
          "carex,fl,ga", "daucus,nc,ga,fl", "erica,bc", "lonely"]
RATINGS = [(u, m, float(1 + (u * 7 + m * 3) % 5)) for u in range(6) for m in range(8) if (u + m) % 3]


def _write_csv(path, rows):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerows(rows)
    with open(path, "w") as f:
        f.write(buf.getvalue())


@pytest.fixture
def files(tmp_dir):
    t1, t2 = os.path.join(tmp_dir, "trees1.csv"), os.path.join(tmp_dir, "trees2.csv")
    _write_csv(t1, TREES)
    _write_csv(t2, [TREES[0], ["9", "", "", "", "", "", "ZOO", ""], ["8", "", "", "", "", "", "MONT-ROYAL", ""]])
    pl = os.path.join(tmp_dir, "plants.data")
    with open(pl, "w") as f:
        f.write("\n".join(PLANTS) + "\n")
    ra = os.path.join(tmp_dir, "ratings.txt")
    with open(ra, "w") as f:
        f.write("".join(f"{u}::{m}::{r}::0\n" for u, m, r in RATINGS))
    return t1, t2, pl, ra


def test_tree_functions(spark, files):
    t1, t2, _, _ = files
    assert api.count(spark, t1).first()[0] == 7
    assert api.parks(spark, t1).first()[0] == 6
    assert [r[0] for r in api.uniq_parks(spark, t1).collect()] == ["AHUNTSIC, PARC", "MONT-ROYAL", "Prével", "ZOO"]
    assert [r.line for r in api.uniq_parks_counts(spark, t1).collect()] == [
        "AHUNTSIC, PARC,2", "MONT-ROYAL,2", "Prével,1", "ZOO,1"]
    assert [r.line for r in api.frequent_parks_count(spark, t1, 3).collect()] == [
        "AHUNTSIC, PARC,2", "MONT-ROYAL,2", "Prével,1"]
    assert [r[0] for r in api.intersection(spark, t1, t2).collect()] == ["MONT-ROYAL", "ZOO"]


def test_rating_functions(spark, files):
    ra = files[3]
    g = api.global_average(spark, ra, 7, split="key").first()[0]
    mi = api.means_and_interaction(spark, ra, 7, 5, split="key").collect()
    assert len(mi) == 5 and [(r.userId, r.movieId) for r in mi] == sorted((r.userId, r.movieId) for r in mi)
    for r in mi:
        assert math.isclose(r.user_item_interaction, r.rating - (r.user_mean + r.item_mean - g))
    assert api.global_average_recommender(spark, ra, 7, split="key").first()[0] >= 0
    assert api.global_average(spark, ra, 7).first()[0] is not None  # random split, as originally


def test_plant_functions(spark, files):
    pl = files[2]
    df = api.data_frame(spark, pl, 3).collect()
    assert [(r.id, r.plant, list(r["items"])) for r in df] == [
        (0, "abelia", ["fl", "nc"]), (1, "abies", ["ak", "bc", "yt"]), (2, "acer", ["fl", "nc", "ga"])]
    assert api.data_preparation(spark, pl, "acer", "ga").first().present is True
    assert api.data_preparation(spark, pl, "acer", "ak").first().present is False
    sets = {}
    for line in PLANTS:
        p, *st = line.split(",")
        for s in st:
            sets.setdefault(s, set()).add(p)
    assert api.distance2(spark, pl, "fl", "ak").first().distance == len(sets["fl"] ^ sets["ak"])
    fi = {tuple(r["items"]): r.freq for r in api.frequent_itemsets(spark, pl, 100, 0.3, 0.5).collect()}
    baskets = [set(line.split(",")[1:]) for line in PLANTS]
    items = sorted(set().union(*baskets))
    want = {c: sum(1 for b in baskets if set(c) <= b) for k in range(1, 4)
            for c in itertools.combinations(items, k)}
    assert fi == {c: f for c, f in want.items() if f >= math.ceil(0.3 * len(PLANTS))}
    assert api.interests(spark, pl, 10, 0.3, 0.5).count() == api.association_rules(spark, pl, 10, 0.3, 0.5).count()
    classes = {r.member: r.leader for r in api.kmeans(spark, pl, 2, 123, chosen=["ak", "fl"]).collect()}
    assert classes["bc"] == classes["yt"] == classes["ak"]
    assert classes["ga"] == classes["fl"]


def test_lsh_functions(spark, files):
    pl = files[2]
    assert api.hash_plants(spark, 123, 12, 7, 99).first().h == 6
    assert api.hash_list(spark, 123, 150, 10, 7, 32).first().h == 61
    assert [r.p for r in api.primes(spark, 5, 41).orderBy("i").collect()] == [41, 43, 47, 53, 59]
    r = api.get_b_and_r(spark, 100, 0.8).first()
    assert (r.b, r.r, r.n_real) == (9, 11, 99)
    sig = {r.i: r.h for r in api.signatures(spark, pl, 123, 6, "ak").collect()}
    # brute force: index = alphabetical rank of the plant over all lines, m = line count
    order = sorted(line.split(",")[0] for line in PLANTS)
    from quarry.operators import lsh
    fam = lsh.hash_family(spark, 123, 6, len(PLANTS))
    ak = [order.index(line.split(",")[0]) for line in PLANTS if "ak" in line.split(",")[1:]]
    assert sig == {i: min((a * x + b) % p for x in ak) for i, a, b, p in fam}
    buckets = api.hash_bands(spark, pl, 123, 3, 2).collect()
    members = {}
    for row in buckets:
        members.setdefault((row.band, row.bucket), set()).add(row.member)
    # ak, bc and yt share the plants abies and betula except bc's erica: ak and yt are identical
    assert any({"ak", "yt"} <= m for m in members.values())
    assert api.hash_band(spark, pl, 123, "ak", 6, 1, 2).first().bucket == \
        api.hash_band(spark, pl, 123, "yt", 6, 1, 2).first().bucket


def test_start_states_from_a_candidate_list(spark, files):
    import random

    pl = files[2]
    cands = ["yt", "fl", "ak", "nc", "bc", "ga"]
    want = random.Random(123).sample(cands, 3)
    random.seed(123)
    assert want == random.sample(cands, 3)
    got = [r.entity for r in api.init_centroids(spark, pl, 3, 123, candidates=cands).orderBy("cluster").collect()]
    assert got == sorted(want)
