import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import gam_quality, perplexity, toxicity
from quarry.llm.text_features import NAMES, features

from . import brute
from .conftest import by_id


@pytest.fixture(scope="module")
def labelled(spark):
    """Documents of random syllables; some with insults, some with junk."""
    rng = random.Random(3)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    bad = ["idiot", "scumbag", "worthless"]
    docs, labels = [], []
    for i in range(700):
        w = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(60, 120))]
        toxic, quality = i % 7 == 0, int(i % 5 != 0)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        if not quality:
            w = [x + "%%%" for x in w]
        docs.append((i, " ".join(w), "en"))
        if i % 10 != 9:
            labels.append((i, quality, int(toxic)))
    docs += [(1000, None, None), (1001, "", "en"), (None, "la le li", "en"), (1002, "you are an idiott and a scumbg, worthles man", "en")]
    labels += [(1000, None, None), (None, 1, 1), (3, 1, 0)]
    return (spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id LONG, text STRING, lang STRING, score DOUBLE"),
            spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT"))


def accuracy(df, labels, label):
    rows = df.where("held_out").join(labels.dropDuplicates(["doc_id"]), "doc_id").where(F.col(label).isNotNull())
    return rows.select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0], rows.count()


def test_quality_held_out(labelled):
    df = gam_quality.quality(*labelled)
    share, n = accuracy(df, labelled[1], "quality")
    assert n > 100 and share > 0.97
    rows = by_id(df)
    assert len(rows) == 704 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for x in rows.values() for r in x)
    assert rows[1000][0].score == rows[1001][0].score


def test_toxicity_held_out_and_misspelled(labelled):
    df = toxicity.toxicity(*labelled)
    share, n = accuracy(df, labelled[1], "toxic")
    assert n > 80 and share > 0.97
    rows = by_id(df)
    assert rows[1002][0].predicted == 1 and rows[1000][0].score == rows[1001][0].score < 0.5
    model = toxicity.train(*labelled, F.lit(False))
    kept = toxicity.not_toxic(labelled[0], model)
    assert kept.columns == labelled[0].columns
    assert 1002 not in {r.doc_id for r in kept.collect()}


def test_models_without_usable_labels(labelled, spark):
    docs, labels = labelled
    none = labels.where("false")
    assert all(r.score < 1e-6 for r in gam_quality.quality(docs, none).collect())
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    one = labels.where("toxic = 0 AND quality = 1")
    assert {r.predicted for r in toxicity.toxicity(docs, one).collect()} == {0}
    assert {r.predicted for r in gam_quality.quality(docs, one).collect()} == {1}
    assert gam_quality.quality(docs.where("false"), labels).count() == 0
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_trie_meets_automaton():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(5, 8))) for _ in range(60)})
    trie = toxicity.Trie(terms)
    lex = toxicity.Lexicon({t: 1.0 for t in terms}, frozenset(terms))
    for _ in range(300):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(3, 10)))
        for k in (0, 1, 2):
            assert sorted(trie.within(w, k)) == sorted((t, d) for t in terms if (d := levenshtein(w, t)) <= k)
        assert bool(lex.look_up(w)) == any(levenshtein(w, t) <= 1 for t in terms)  # the prefilter loses nothing


def test_quotation_is_apart_from_abuse():
    lex = toxicity.Lexicon({"idiot": 2.0}, frozenset(["idiot"]))
    abuse = toxicity.context_features("you are an idiot and I know it", lex)
    quoted = toxicity.context_features('the word "idiot" comes from Greek', lex)
    assert abuse[0] > 0 == abuse[1] and quoted[0] == 0 < quoted[1]
    near = toxicity.context_features("you are an idiott and I know it", lex)
    assert 0 < near[0] < abuse[0] and near[1] == 0
    assert toxicity.context_features("", lex) == [0.0] * toxicity.N_FEATURES


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    gam = gam_quality.fit(x, y)
    assert (1, 0) in gam.pairs
    assert ((gam.score(x) > 0.5) == y).mean() > 0.95
    plain = gam_quality.Gam(gam.intercept, gam.edges, gam.tables)
    assert ((plain.score(x) > 0.5) == y).mean() < 0.65


def test_features_of_odd_texts():
    x = features(pa.array([None, "", "   ", "a", "A b\nA b", "x" * 3_000_000, "é|é"]))
    assert x.shape == (7, len(NAMES)) and np.isfinite(x).all()
    assert (x[0] == 0).all() and (x[1] == 0).all()
    assert x[4][NAMES.index("repeated_lines")] == 0.5 and x[4][NAMES.index("distinct_words")] == 0.5


def test_quality_rules(docs, rows, empty):
    out = by_id(perplexity.quality_rules(docs))
    for i, t, *_ in rows:
        for r in out[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(t)
            assert not (r.kept and r.base_failed)
    assert sum(map(len, out.values())) == len(rows)
    assert out[53][0].perplexity is None and not out[53][0].kept
    assert perplexity.quality_rules(empty).count() == 0


def test_rules_reject_what_the_model_finds_odd(labelled):
    """Junk is a fifth of the corpus, clean text stays."""
    df = perplexity.quality_rules(labelled[0]).join(labelled[1].where("quality IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id")
    kept = {r.quality: r.k for r in df.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.01


def test_ngram_counts_cover_all_text(spark):
    texts = ["ab", None, "", "Ab 1.", "abababab"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(3)
    got = {r.code: r.n for r in perplexity.ngram_counts(df).collect()}
    want = {}
    for t in texts:
        c = [26] * (perplexity.ORDER - 1) + [int(perplexity.CLASS[b]) for b in (t or "").encode()]
        for k in range(len(c) - perplexity.ORDER + 1):
            code = sum(v << 5 * (perplexity.ORDER - 1 - j) for j, v in enumerate(c[k: k + perplexity.ORDER]))
            want[code] = want.get(code, 0) + 1
    assert got == want


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(4)
    code = np.unique(rng.integers(0, 32**perplexity.ORDER, 3000))
    n = rng.integers(1, 9, len(code))
    p = np.exp(perplexity.KneserNey(code, n).log_table()).reshape(-1, 32)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-9)


def brute_log_p(texts):
    """Perplexity of each text by counting again without each occurrence."""
    n5, n4 = {}, {}
    for t in texts:
        t = " " * 4 + t
        for k in range(4, len(t)):
            n5[t[k - 4: k + 1]] = n5.get(t[k - 4: k + 1], 0) + 1
    for g in n5:
        n4[g[1:]] = n4.get(g[1:], 0) + 1

    def cuts(counts):
        d = (0.0, *perplexity._discounts(np.array(list(counts.values()))))
        return lambda n: d[min(n, 3)]

    code = {}
    for g, k in n5.items():
        c = perplexity.class_code([np.array([ord(x)], dtype=np.uint64) for x in g[:0:-1]])[0]
        code[int(c)] = code.get(int(c), 0) + k
    at = np.array(sorted(code))
    table = np.exp(perplexity.KneserNey(at, np.array([code[x] for x in at])).log_table())
    members = np.bincount(perplexity.CLASS[:128], minlength=32).astype(float)
    members[perplexity._OTHER] += len({g[-1] for g in n5 if ord(g[-1]) >= 128})

    def base(g):
        c = int(perplexity.class_code([np.array([ord(x)], dtype=np.uint64) for x in g[::-1]])[0])
        return table[c] / members[c & 31]

    def level(counts, cut, g, low, gone):
        own = {h: n - (gone if h == g else 0) for h, n in counts.items() if h[:-1] == g[:-1]}
        total = sum(own.values())
        return low if not total else (own[g] - cut(own[g]) + sum(map(cut, own.values())) * low) / total

    cut5, cut4 = cuts(n5), cuts(n4)
    out = {g: np.log(level(n5, cut5, g, level(n4, cut4, g[1:], base(g[1:]), int(n == 1)), 1)) for g, n in n5.items()}
    return [float(np.exp(-np.mean([out[(" " * 4 + t)[k: k + 5]] for k in range(len(t))]))) if t else None for t in texts]


def test_perplexity_of_real_characters(spark):
    texts = ["the cat sat on the mat", "", "кот сидел на ковре, кот спал", "猫は敷物の上に座った 猫", "the cat 😀 sat", "the cat sat on the mat", "é"]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id LONG, text STRING, lang STRING").repartition(3)
    out = by_id(perplexity.quality_rules(df))
    for k, want in enumerate(brute_log_p(texts)):
        assert out[k][0].perplexity == (None if want is None else pytest.approx(want, rel=1e-9))


def test_gibberish_in_any_script_is_odd(spark):
    """Same alphabet, same word lengths: only real characters tell shuffled letters from words."""
    rng = random.Random(8)
    docs = []
    for lang, letters in (("ru", "абвгдежзиклмнопрстуфхцчшщыьэюя"), ("zh", [chr(0x4E00 + 7 * k) for k in range(400)]), ("en", "abcdefghijklmnopqrstuvwxyz")):
        vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(150)]
        for k in range(120):
            w = [rng.choice(vocabulary) for _ in range(90)]
            if k % 12 == 0:
                pool = [c for x in w for c in x]
                rng.shuffle(pool)
                w = ["".join(pool.pop() for _ in x) for x in w]
            docs.append((len(docs), " ".join(w), lang, k % 12 == 0))
    df = spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, odd BOOLEAN")
    out = perplexity.quality_rules(df).join(df.select("doc_id", "odd", "lang"), "doc_id")
    kept = {(x.lang, x.odd): x.k for x in out.groupBy("lang", "odd").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    for lang in ("ru", "zh", "en"):
        assert kept[lang, True] == 0 and kept[lang, False] > 0.95


def test_model_grows_with_the_corpus(spark):
    rng = random.Random(2)
    docs = [("".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(2000)),) for _ in range(20)]
    n = [perplexity.ngram_model(spark.createDataFrame(docs[:k], "text STRING")).count() for k in (5, 20)]
    assert n[1] > 3.9 * n[0]


def test_lexicon_keeps_every_term(spark):
    """5,000 words that all stand in every toxic document and in no clean one."""
    rng = random.Random(3)
    terms = [f"bad{k}x" for k in range(5000)]
    rows = [(i, " ".join(rng.sample(terms, len(terms))), 1) for i in range(12)]
    rows += [(100 + i, " ".join(f"fine{rng.randrange(300)}" for _ in range(30)), 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT")
    model = toxicity.train(df.drop("toxic"), df.select("doc_id", "toxic"), F.lit(False), max_edits=0)
    assert set(model.weights) == set(terms)
