import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import importance as im
from quarry.llm.common import Scratch
from tests.llm.brute import LAST, lower, rank

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feats(t, least, most):
    w = WORD.findall(lower(t or ""))
    return len(w), [" ".join(w[i: i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=10, min_words=20, least=1, most=1, buckets=10_000, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    docs = [(i, *feats(t, least, most)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in docs for f in fs)
    t = Counter(bucket(f) for x in target for f in feats(x, least, most)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in s}
    out = []
    for i, n, fs in docs:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((k for k, r in enumerate(out) if r[1] >= min_words), key=lambda k: (-out[k][4], rank(out[k][0])))
    drawn = {k: p for p, k in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted(((i, n, w, s, drawn.get(k)) for k, (i, _, n, w, s) in enumerate(out)), key=str)


def target_table(spark, texts):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "item_id LONG, text STRING, weight INT")


TARGET = ["w1 w2 w3 W4 edit5", None, "", "é ü 漢字", "the same old line here", " ".join(f"w{k}" for k in range(300))]


@pytest.mark.parametrize("given", [{}, {"percent": 50, "min_words": 5, "least": 1, "most": 3, "buckets": 97, "seed": 3, "part_rows": 4}])
def test_as_brute_force(spark, docs, rows, given):
    got = im.importance_resampling(docs, target_table(spark, TARGET), **given)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    given.pop("part_rows", None)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in rows], TARGET, **given)


def test_empty_tables(spark, docs, empty, rows):
    assert im.importance_resampling(empty, target_table(spark, TARGET)).count() == 0
    got = im.importance_resampling(docs, target_table(spark, []))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in rows], [])


def test_ranks_over_many_segments_with_ties_and_repeated_rows(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("score"), F.when(F.col("id") % 3 == 0, 11).otherwise(F.col("id")).alias("id"),
                                    F.col("id").alias("row")).repartition(9)
    for drawn in (0, 1, 1234, 5000):
        got = im.draw(rows, 5000, drawn, Scratch(spark), part_rows=300).collect()
        want = sorted(((r["score"], r["id"], r["row"]) for r in got), key=lambda x: (-x[0], x[1], x[2]))
        assert len(got) == 5000
        assert {r["rank"]: (r["score"], r["id"], r["row"]) for r in got if r["rank"]} == dict(enumerate(want[:drawn], 1))


def test_keys_sort_as_score_id_row():
    rng = np.random.default_rng(1)
    big = np.array([LAST, -LAST - 1, 0, -1, 1, 255, 256], dtype=np.int64)
    score, i, row = (rng.choice(big, 300) for _ in range(3))
    want = np.lexsort((row, i, ~score))
    assert (im.sort_keys(score, i, row)[want] == np.sort(im.sort_keys(score, i, row))).all()
