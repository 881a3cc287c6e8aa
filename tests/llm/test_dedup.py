import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, jaccard, line_dedup, seed_dedup, suffix_dedup
from quarry.llm.components import components
from quarry.llm.queries import QUERIES

from . import brute


def texts(rows):
    return [(r[0], r[1]) for r in rows]


def got(df, *cols):
    return Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select("doc_id", *cols).collect())


def test_line_dedup(docs, rows, empty):
    want = Counter(brute.line_dedup(texts(rows)))
    for batches, fanout in ((1, 3), (7, 2)):  # with and without compaction of runs
        df = line_dedup.line_dedup(docs, batches=batches, fanout=fanout)
        assert got(df, "n_lines", "n_dropped", "kept_text") == want
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    for k in range(5):
        keys = spark.range(10 * k, 10 * k + 12).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), F.lit(k).cast("long").alias("first"),
                                                       F.lit(k).cast("long").alias("last"))
        lost = runs.add(keys)
        assert lost.count() == (2 if k else 0)  # two keys of the batch before
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sum(x.count() for x in runs.runs()) == 52
    plan = spark.range(50).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("key")).join(runs.runs()[0].hint("merge"), "key", "left_anti")
    assert plan._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1  # the run isn't shuffled
    runs.close()


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup(docs, rows, empty, hot):
    df = suffix_dedup.suffix_dedup(docs, length=60, gram=12, hot=hot)
    want = Counter(brute.suffix_dedup(texts(rows), 60))
    assert got(df, "n_bytes", "n_removed", "n_spans", "kept") == want
    assert suffix_dedup.suffix_dedup(empty).count() == 0
    with pytest.raises(ValueError, match="gram"):
        suffix_dedup.suffix_dedup(empty, length=5, gram=5)


def test_op5_removes_planted_passages_from_400_bytes_on(spark, tmp_path):
    """The contract counts bytes, not words: of passages of over 50 words those under 400 bytes stay whole."""
    rng = random.Random(3)
    rows, want = [], {}
    for size in (330, 398, 399, 400, 401, 520):
        passage = " ".join("%05x" % rng.randrange(16**5) for _ in range(size // 6 + 1))[:size]  # 55 to 87 words
        assert len(brute.WORD.findall(passage)) > 50
        for k in "xy":  # its neighbours differ on both sides
            around = ["".join(rng.choice("klmnop ") for _ in range(600)) for _ in range(2)]
            want[len(rows)] = size if size >= 400 else 0
            rows.append((len(rows), f"{around[0]}{k}{passage}{k}{around[1]}"))
    spark.createDataFrame(rows, "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op5_suffix_dedup"](spark, str(tmp_path)).cache()
    assert {r.doc_id: r.n_removed for r in df.collect()} == want
    brutes = Counter((i, n, gone, spans, brute.sha(kept)) for i, n, gone, spans, kept in brute.suffix_dedup(rows, 400))
    assert got(df, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brutes
    df.unpersist()


def test_suffix_dedup_reads_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    monkeypatch.setattr(suffix_dedup, "LENGTH_MAX", 60)
    t = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(2500))
    col = __import__("pyarrow").array([t, None, "short", t[300:900]])
    found = set()
    for row, first, n, _off, _seed, _same in suffix_dedup._spans_of(col, 60, 12):
        for r, f, k in zip(row.tolist(), first.tolist(), n.tolist()):
            for p in range(f, f + k):
                assert (r, p) not in found
                found.add((r, p))
    assert found == {(0, p) for p in range(2500 - 59)} | {(3, p) for p in range(600 - 59)}


@pytest.mark.parametrize("rest", [0, 1, 59, 60, 80, 119, 120, 121, 300])
def test_suffix_dedup_takes_each_window_of_a_long_text_once(monkeypatch, rest):
    """The last piece may be shorter than what the piece before it reads on."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    monkeypatch.setattr(suffix_dedup, "LENGTH_MAX", 120)
    size = 2000 + rest
    t = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(size))
    found = [p for _row, first, n, *_ in suffix_dedup._spans_of(__import__("pyarrow").array([t]), 60, 12)
             for f, k in zip(first.tolist(), n.tolist(), strict=True) for p in range(f, f + k)]
    assert sorted(found) == list(range(size - 59))


def test_match_marks_every_repeated_window():
    import random

    import numpy as np

    rng = random.Random(5)
    for trial in range(30):
        core = "".join(rng.choice("ab") for _ in range(14))
        bodies, off = [], []
        for _ in range(rng.randrange(2, 12)):
            left = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 8)))
            right = "".join(rng.choice("ab") for _ in range(rng.randrange(6, 9)))
            bodies.append((left + core + right).encode())
            off.append(len(left))
        length = 18
        who, first, count = suffix_dedup.match(np.zeros(len(bodies), dtype=np.int64), bodies, np.array(off), np.ones(len(bodies)), length)
        marked = {(w, p) for w, f, c in zip(who.tolist(), first.tolist(), count.tolist()) for p in range(f, f + c)}
        want = set()
        for x, b in enumerate(bodies):
            for p in range(len(b) - length + 1):
                for y, c in enumerate(bodies):
                    q = p - off[x] + off[y]
                    if x != y and 0 <= q <= len(c) - length and 0 <= off[x] - p and off[x] - p <= length and b[p: p + length] == c[q: q + length]:
                        want.add((x, p))
        assert marked == want, trial


def test_seed_dedup(docs, rows, empty):
    for n, k in ((13, 3), (4, 2)):
        df = seed_dedup.seed_dedup(docs, n=n, k=k)
        assert got(df, "n_words", "n_removed", "kept_text") == Counter(brute.seed_dedup(texts(rows), n))
    assert seed_dedup.seed_dedup(empty).count() == 0


def test_seed_dedup_across_flushes(docs, rows):
    assert got(seed_dedup.seed_dedup(docs, flush=20), "n_words", "n_removed", "kept_text") == Counter(brute.seed_dedup(texts(rows)))
    with pytest.raises(ValueError, match="gram"):
        seed_dedup.seed_dedup(docs, n=3, k=4)


def test_extension_compares_words_beyond_the_anchor():
    """Runs with one anchor; each differs from the others in one word before or after it."""
    import numpy as np

    n, k, off = 5, 2, 3
    words = [list(range(10, 18)) for _ in range(8)]  # an anchor of words 13 and 14, four windows
    for i, j in enumerate((0, 1, 2, 5, 6, 7)):
        words[i + 1][j] = 100 + i
    hit = seed_dedup.extend(np.array(words).ravel(), np.arange(8) * 8, np.full(8, off), np.full(8, 4), np.arange(8), n, k)
    seen, want = set(), []
    for w in words:
        grams = [tuple(w[p: p + n]) for p in range(4)]
        want += [g in seen for g in grams]
        seen.update(grams)
    assert hit.tolist() == want


def test_seed_dedup_rows_without_id_keep_their_own_marks(spark):
    """Many different texts share the null id; two of them, a long and a short one, agree in the low 16 bits of the hash."""
    short = [f"s{k} short" for k in range(3000)]
    texts_ = spark.createDataFrame([(t,) for t in short], "t STRING")
    passage = " ".join(f"p{k}" for k in range(20))
    long = " ".join(f"w{k}" for k in range(40)) + " " + passage
    found = []
    for k in range(2000):  # a long text whose tag ends as that of a short one
        found.append((f"x{k} {long}",))
    pairs = (spark.createDataFrame(found, "l STRING").withColumn("k", seed_dedup.row_tag(F.col("l")).bitwiseAND(F.lit(0xFFFF)))
             .join(texts_.withColumn("k", seed_dedup.row_tag(F.col("t")).bitwiseAND(F.lit(0xFFFF))), "k").limit(1).collect())
    assert pairs
    # other texts without id: each takes its own passage's marks only
    rows = [(1, passage), (None, pairs[0].l), (None, pairs[0].t), *((None, t) for t in short[:300])]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    assert got(seed_dedup.seed_dedup(df), "n_words", "n_removed", "kept_text") == Counter(brute.seed_dedup(rows))


def test_jaccard_join(docs, rows, empty):
    want = Counter(brute.jaccard(texts(rows)))
    assert got(jaccard.jaccard_join(docs), "n_shingles", "component_id") == want
    assert jaccard.jaccard_join(empty).count() == 0
    with pytest.raises(ValueError, match="0.8"):
        jaccard.jaccard_join(docs, percent=70)


def test_jaccard_join_across_blocks(docs, rows):
    """Blocks of two documents: every family is spread over several."""
    assert got(jaccard.jaccard_join(docs, block_docs=2), "n_shingles", "component_id") == Counter(brute.jaccard(texts(rows)))


def _near_rows():
    """Chains of near copies and rows with one id and different texts."""
    rng = random.Random(11)
    rows = []
    for f in range(6):
        base = [f"f{f}w{k}" for k in range(60)]
        for k in range(12):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                w[rng.randrange(60)] = f"e{rng.randrange(40)}"
            rows.append((100 * f + k, " ".join(w)))
            base[rng.randrange(60)] = f"drift{f}.{k}"      # the ends of a chain link only through the middle
    first, second, third = rows[0][1], rows[20][1], rows[40][1]
    alone = " ".join(f"z{k}" for k in range(30))
    rows += [(900, first), (900, alone), (901, alone.replace("z0 ", "y ")), (902, third), (902, second),
             (903, ""), (903, alone), (904, ""), (None, first), (None, alone)]
    return rows


@pytest.mark.parametrize("block_docs", [2, jaccard.BLOCK_DOCS])
def test_jaccard_join_of_repeated_ids_and_chains(spark, block_docs):
    """A link of any text of an id counts; families over many blocks are settled through hubs."""
    rows = _near_rows()
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    want = Counter(brute.jaccard(rows))
    assert got(jaccard.jaccard_join(df, block_docs=block_docs), "n_shingles", "component_id") == want
    assert {c for i, _, c in want if i in (901, 903)} == {0, 903}  # the empty text of 903 links with nothing


def test_equal_sets_of_many_rows_are_packed_once(spark):
    rows = [(k, "one two three four five six seven") for k in range(500)] + [(1000, "one two three four five six seven eight")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    assert got(jaccard.jaccard_join(df), "n_shingles", "component_id") == Counter(brute.jaccard(rows))


def test_one_per_group(docs, rows):
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns
    comp = {i: c for i, _, c in brute.jaccard(texts(rows))}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in texts(rows) if i is None or comp[i] == i)


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 40), (100, 41), (41, 42), (7, 7)]
    df = components(spark.createDataFrame(links, "x LONG, y LONG"), "x", "y")
    out = {r.vertex: r.component for r in df.collect()}
    assert out == {**{k: 0 for k in range(31)}, **{k: 40 for k in (40, 41, 42, 100)}}
    assert components(spark.createDataFrame([], "x LONG, y LONG"), "x", "y").count() == 0


@pytest.mark.parametrize("capacity", [5, exact_dedup.CAPACITY])
def test_exact_dedup(docs, rows, empty, capacity):
    out = exact_dedup.exact_dedup(docs, capacity=capacity).collect()
    want = Counter(brute.exact(texts(rows)))
    assert Counter((r.doc_id, brute.rank(r.keep_id), r.group_size, r.text_sha256) for r in out) == want
    kept = Counter(r.text_sha256 for r in out if r.kept)
    assert set(kept) == {w[3] for w in want} and set(kept.values()) == {1}
    assert all(r.keep_id == r.doc_id for r in out if r.kept)
    assert exact_dedup.exact_dedup(empty).count() == 0
    rest = exact_dedup.deduplicate(docs)
    assert rest.columns == docs.columns
    assert Counter(r.doc_id for r in rest.collect()) == Counter(r.doc_id for r in out if r.kept)


def test_owner_resolves_collided_keys_by_bytes(spark, docs, rows):
    """All texts share one of two keys; large groups are reduced before they reach the owner."""
    def two_keys(norm):
        return F.when(F.length(norm) % 2 == 0, F.lit(5).cast("long")).otherwise(F.lit(-(2**62)))

    _, index, buckets = exact_dedup.build_index(docs, capacity=1, hot=2, key=two_keys)
    want = {(brute.GAP.sub(" ", t or ""), k, n) for (_, t), (_, k, n, _) in zip(texts(rows), brute.exact(texts(rows)), strict=True)}
    found = index.collect()
    assert {(x.norm, x.keep, x.n) for x in found} == want and len(found) == len(want)
    for k in (5, -(2**62)):
        assert sorted(x.chain for x in found if x.key == k) == list(range(sum(x.key == k for x in found)))
    assert len({x.bucket for x in found}) == 2
    # a second batch is looked up in the files: a copy, a text of the same key, and a text that isn't there
    later = spark.createDataFrame([(900, "One\ttwo  three four"), (901, "five"), (902, None)], "doc_id LONG, text STRING")
    got_ = {x.doc_id: (x.keep_id, x.found) for x in exact_dedup.match_batch(later, index, buckets, key=two_keys).collect()}
    assert got_ == {900: (58, True), 901: (None, False), 902: (53, True)}


def test_directory_splits_and_doubles():
    found = exact_dedup.directory({0: 5, 1: 5, 2: 1, 7: 2}, capacity=6, max_bits=3)
    assert found == [(0, 3, 5), (1, 3, 5), (2, 2, 1), (4, 1, 2)]
    assert exact_dedup.directory({}, 6, 3) == [(0, 0, 0)]
    # copies can't be split by more bits: the bucket stays over capacity
    assert (0, 3, 50) in exact_dedup.directory({0: 50}, 6, 3)


def test_line_keys_are_computed_once_for_a_join(spark):
    from quarry.llm.line_dedup import lines_of

    docs = spark.createDataFrame([(1, "a line of text\nanother line")], "doc_id long, text string")
    lost = spark.createDataFrame([(b"x", 1)], "key binary, first long")
    plan = lines_of(docs, "doc_id", "text", 10).join(lost, "key")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
