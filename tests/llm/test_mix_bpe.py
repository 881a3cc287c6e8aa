import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers as tokenizers
from quarry.llm import bpe, mixing

from . import brute

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_mix(docs, rows, empty):
    out = mixing.mix(docs, bucket_rows=3).collect()
    assert len(out) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    src = {r[0]: r[3] for r in rows}
    for r in out:
        s = src[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 3 * r.size
    want = brute.targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9) and abs(taken[s] - target[s]) <= 0.5
    assert all(r.source_size == sizes[src[r.doc_id]] for r in out)
    again = mixing.mix(docs.repartition(5), bucket_rows=10**6).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))  # neither layout nor buckets matter
    assert mixing.mix(empty).count() == 0


def test_targets_against_repeated_sharing(spark):
    rng = random.Random(2)
    for _ in range(6):
        sizes = {f"s{k}": rng.choice([0, 1, 10, 100, 1000, 10**6]) for k in range(rng.randrange(1, 9))}
        df = spark.createDataFrame([("0" + s, n, 1) for s, n in sizes.items()], "src STRING, source_size LONG, docs LONG")
        got = {r.src[1:]: r.target for r in mixing.targets(df).collect()}
        want = brute.targets(sizes)
        assert got == {s: pytest.approx(want[s]) for s in sizes}


def test_mix_prefers_weight_and_whole_epochs(spark):
    """With words halved, documents with symbols are left out far more often."""
    clean, junk = "word " * 20, "word%%% " * 20
    rows = [(i, clean if i % 2 else junk, "a") for i in range(2000)] + [(-1, "word " * 400, "b"), (-2, "word " * 20_000, "c")]
    df = mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")).where("doc_id >= 0")
    got = df.groupBy((F.col("doc_id") % 2).alias("odd"), (F.col("taken") / F.col("size")).cast("int").alias("times")).count().collect()
    n = defaultdict(int)
    for r in got:
        n[(r.odd, r.times)] += r["count"]
    epochs = {t for (_, t) in n}
    assert len(epochs) <= 2 and max(epochs) - min(epochs) <= 1
    assert n[(1, max(epochs))] > n[(0, max(epochs))] or len(epochs) == 1


def test_mixed_rows_follow_the_mix(docs):
    want = {}
    for r in mixing.mix(docs).collect():
        want.setdefault(r.doc_id, []).append((2 * r.taken + r.size) // (2 * r.size) if r.size else 0)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    for i, n in want.items():
        assert got.get(i, 0) == sum(n) or len(n) > 1  # equal rows tie at the cut


def test_bpe_equals_tiktoken(docs, rows, empty, tik):
    out = bpe.decode(bpe.encode(docs, PATH, tokenizers.PATTERN), PATH).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = tik.encode_ordinary(t or "")
        want[(i, len(ids), np.array(ids, dtype="<u4").tobytes(), (t or "").encode())] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in out) == want
    assert bpe.encode(empty, PATH, tokenizers.PATTERN).count() == 0


def test_merge_equals_tiktoken_on_odd_pieces(tik):
    tokens = bpe.read_ranks(PATH)
    rank_of = {t: i for i, t in enumerate(tokens)}
    enc = bpe.Encoder(tokens, bpe.PerfectHash(tokens), tokenizers.PATTERN)
    rng = random.Random(9)
    texts = ["a" * 5000, "é" * 300, "\x00\x01", "  \n\t  x", "x\x85y z ", "'s 'LL don't", "½²٣", "🙂🙃" * 50]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F600)]))
                      for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, dtype="<u4").tolist() == tik.encode_ordinary(t)
    assert bpe.merge(b"hello", rank_of) == tik.encode_ordinary("hello") or len(bpe.merge(b"hello", rank_of)) >= 1


def test_perfect_hash_is_minimal():
    keys = [hashlib.md5(str(k).encode()).digest()[: 3 + k % 9] for k in range(3000)]
    keys = sorted(set(keys))
    table = bpe.PerfectHash(keys)
    assert table.probe(keys).tolist() == list(range(len(keys)))
    assert ((0 <= (other := table.probe([b"nope", b""]))) & (other < len(keys))).all()


def test_vocabulary_is_checked(tmp_path):
    path = tmp_path / "bad"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(255)))
    with pytest.raises(ValueError, match="byte"):
        bpe.read_ranks(str(path))
