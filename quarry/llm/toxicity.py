"""Toxicity by a fuzzy lexicon with context windows (operator 4).

Method. Spark counts, over a bounded sample of labelled documents, in how many
toxic and clean documents each word stands, and in how many different contexts;
words that are far commoner in toxic ones than chance allows form the lexicon,
held as a trie; copies of a document share their contexts and count once.
Words of a text match exactly or within ``max_edits`` insertions, deletions or
substitutions: the word's Levenshtein automaton is intersected with the trie,
whose edges advance the automaton's state row and are pruned once no state is
within reach. A window of words around each hit tells abuse from quotation:
hits inside quotation marks, or after a word of saying or naming, are summed
apart. A logistic regression over these sums, learned from the same sample,
gives the score.

Scale. Learning reads at most ``sample`` labelled rows whatever the corpus
holds; the lexicon holds every word of these rows that passes the tests, so the
sample bounds it, and is broadcast. Scoring is a map over rows without a shuffle. Matches of recent words are cached, with a
bound.

Edge cases. A null or empty text scores like any text without hits. Without
usable labels of both kinds the lexicon is empty and every score is the share
of toxic labels (0 without labels). Null ids are scored as well. Repeated rows
are kept; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, ship_package
from quarry.llm.labels import fold, labelled_sample
from quarry.llm.rolling import pieces

SAMPLE = 20_000        # labelled rows to learn from, at most
MIN_EVIDENCE = 10.0    # log-likelihood ratio of a term's share of toxic documents; chance words stay below
MIN_FUZZY = 5          # shorter terms match exactly only
NEAR = 0.8             # share of a term's weight that a word one edit away has
WINDOW = 6             # words on each side of a hit
CACHE = 300_000

WORD = re.compile(r"[^\W_]+")
#: fixed values: marks that open and close quotations, words that introduce a mention
OPEN, CLOSE = "\"“„«‹‘", "\"”“»›’"
SAYING = frozenset("said says called calls word words term quote quoted wrote named sagte nannte wort dit mot mots dijo palabra".split())


class Trie:
    """Lexicon terms as nested dictionaries; the key None holds the term."""

    def __init__(self, terms: Iterable[str]):
        self.root: dict = {}
        for t in terms:
            node = self.root
            for ch in t:
                node = node.setdefault(ch, {})
            node[None] = t

    def within(self, word: str, k: int) -> list[tuple[str, int]]:
        """Terms at distance at most k: the intersection with the word's Levenshtein automaton.

        The automaton's state is a row of distances, one for each prefix of the word."""
        found = []
        todo = [(self.root, list(range(len(word) + 1)))]
        while todo:
            node, row = todo.pop()
            for ch, child in node.items():
                if ch is None:
                    if row[-1] <= k:
                        found.append((child, row[-1]))
                    continue
                new = [row[0] + 1]
                for j, c in enumerate(word, 1):
                    new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != ch)))
                if min(new) <= k:
                    todo.append((child, new))
        return found


class Lexicon:
    """Weighted terms with exact and fuzzy lookup."""

    def __init__(self, weights: dict[str, float], fuzzy: frozenset[str], max_edits: int = 1):
        self.weights, self.k = weights, max_edits
        long = [t for t in weights if t in fuzzy and len(t) >= MIN_FUZZY]
        self.trie = Trie(long)
        self.shortest = min(map(len, long), default=1 << 30) - max_edits
        self.longest = max(map(len, long), default=0) + max_edits
        # at most k edits leave one of k + 1 pieces whole; for one edit it is the first half as
        # a prefix or the second half as a suffix, a cheap test that loses no match
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for t in long:
            h = len(t) // 2
            self.heads.setdefault(h, set()).add(t[:h])
            self.tails.setdefault(len(t) - h, set()).add(t[h:])
        self.cache: dict[str, tuple[float, int, str] | None] = {}

    def _may_match(self, w: str) -> bool:
        if self.k != 1:
            return True
        return any(w[:h] in s for h, s in self.heads.items()) or any(w[-h:] in s for h, s in self.tails.items())

    def look_up(self, w: str) -> tuple[float, int, str] | None:
        """(weight, distance, term) of the best term for a word, or None."""
        if w in self.weights:
            return self.weights[w], 0, w
        if self.shortest <= len(w) <= self.longest and self._may_match(w):
            best = min(((d, -self.weights[t], t) for t, d in self.trie.within(w, self.k)), default=None)
            if best:
                return -best[1], best[0], best[2]
        return None

    def known(self, words: set[str]) -> dict[str, tuple[float, int, str]]:
        if len(self.cache) > CACHE:
            self.cache.clear()
        for w in words.difference(self.cache):
            self.cache[w] = self.look_up(w)
        return {w: hit for w in words if (hit := self.cache[w])}


def _quoted(text: str, words: list[re.Match], i: int) -> bool:
    """Whether the window around word i marks it as quoted or mentioned."""
    lo, hi = words[max(0, i - WINDOW)].start(), words[min(len(words) - 1, i + WINDOW)].end()
    left, right = text[lo: words[i].start()], text[words[i].end(): hi]
    opened = max((left.rfind(c) for c in OPEN), default=-1)
    if opened >= 0 and left.count('"') % 2 + sum(left.count(c) for c in OPEN[1:]) > 0 and any(c in right for c in CLOSE):
        return True
    return any(words[j].group().lower() in SAYING for j in range(max(0, i - 3), i))


N_FEATURES = 5


def context_features(text: str, lex: Lexicon) -> list[float]:
    """Sums and maxima of the hits' weights, abuse apart from quotation, and whether there is any abuse."""
    low = text.lower()
    hits = lex.known(set(WORD.findall(low)))
    if not hits:
        return [0.0] * N_FEATURES
    words = list(WORD.finditer(low))
    total, top = [0.0, 0.0], [0.0, 0.0]
    for i, m in enumerate(words):
        hit = hits.get(m.group())
        if hit:
            weight = hit[0] * NEAR ** hit[1]
            at = int(_quoted(low, words, i))
            total[at] += weight
            top[at] = max(top[at], weight)
    return [float(np.log1p(total[0])), float(np.log1p(total[1])), *top, float(top[0] > 0)]


def _word_rows(batches):
    """Per word of each labelled document: label and a hash of its neighbours."""
    schema = pa.schema([("word", pa.string()), ("y", pa.int32()), ("context", pa.int64())])
    for batch in (p for whole in batches for p in pieces(whole, 0)):
        cols: tuple[list, list, list] = ([], [], [])
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = WORD.findall((text.as_py() or "").lower())
            seen: dict[str, int] = {}
            for i, w in enumerate(words):
                if w not in seen:  # copies of a document share their contexts
                    near = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
                    seen[w] = xxhash.xxh3_64_intdigest(near) >> 1 if y else 0
            cols[0].extend(seen)
            cols[1].extend([y] * len(seen))
            cols[2].extend(seen.values())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _features_rows(shared):
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64())), ("fuzzy", pa.list_(pa.string()))])

    def run(batches):
        lex = Lexicon(*shared.value)
        for batch in (p for whole in batches for p in pieces(whole, 0)):
            texts = [t.as_py() or "" for t in batch.column(0)]
            x = [context_features(t, lex) for t in texts]
            near = [sorted({h[2] for h in lex.known(set(WORD.findall(t.lower()))).values() if h[1]}) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, schema.field(1).type), pa.array(near, schema.field(2).type)], schema=schema)

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        norm = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(norm, 1e-12))
        if norm < 1e-6:
            break
    return w


class Model:
    def __init__(self, weights: dict[str, float], fuzzy: frozenset[str], max_edits: int, w: np.ndarray):
        self.weights, self.fuzzy, self.max_edits, self.w = weights, fuzzy, max_edits, w


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label: str = "toxic", sample: int = SAMPLE, max_edits: int = 1) -> Model:
    """Learns lexicon and weights from at most ``sample`` labelled rows outside ``held_out``."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = labelled_sample(labels, label, held_out, sample, id_col)
    own = Scratch(spark).write(  # read several times; bounded by `sample`
        docs.join(F.broadcast(rows), F.col(id_col).cast("long") == F.col("_lid")).select(F.col(text_col).alias("_text"), F.col("y")), "toxic-sample")
    total = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}  # two rows
    n1, n0 = total.get(1, 0), total.get(0, 0)
    base = n1 / (n0 + n1) if n0 + n1 else 0.0
    flat = np.zeros(N_FEATURES + 1)
    flat[-1] = np.log(max(base, 1e-9) / max(1 - base, 1e-9))
    if not n0 or not n1:
        return Model({}, frozenset(), max_edits, flat)
    toxic, clean = F.sum("y"), F.sum(1 - F.col("y"))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    evidence = F.col("t") * F.log(F.col("share") / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log(
        F.greatest(1 - F.col("share"), F.lit(1e-12)) / (1 - base))).otherwise(0.0)
    terms = (own.mapInArrow(_word_rows, "word string, y int, context long").groupBy("word")
             .agg(toxic.alias("toxic"), clean.alias("clean"), F.countDistinct(F.when(F.col("y") == 1, F.col("context"))).alias("contexts"))
             .withColumn("t", F.least("toxic", "contexts").cast("double")).withColumn("share", F.col("t") / (F.col("t") + F.col("clean")))
             .where((F.col("share") > base) & (F.col("clean") <= 0.02 * n0))
             .withColumn("odds", odds).where((F.col("odds") > 2.5) & (evidence >= MIN_EVIDENCE))
             .orderBy("word").select("word", "odds"))
    weights = {r["word"]: float(r["odds"]) for r in terms.collect()}  # words of at most `sample` rows
    fuzzy = frozenset(weights)
    for last in (False, True):
        shared = spark.sparkContext.broadcast((weights, fuzzy, max_edits))
        got = own.mapInArrow(_features_rows(shared), "y int, x array<double>, fuzzy array<string>").toPandas()  # at most `sample` rows
        y = got["y"].to_numpy(dtype=float)
        if not last:
            # terms whose near words stand in clean documents match exactly only
            bad: dict[str, int] = {}
            good: dict[str, int] = {}
            for near, label_ in zip(got["fuzzy"], y, strict=True):
                for t in near:
                    (good if label_ else bad)[t] = (good if label_ else bad).get(t, 0) + 1
            kept = frozenset(t for t in weights if bad.get(t, 0) / n0 <= 0.01 * good.get(t, 0) / n1)
            if kept == fuzzy:
                break
            fuzzy = kept
    return Model(weights, fuzzy, max_edits, logistic(np.stack(got["x"].to_numpy()), y))


_SCORE = pa.schema([("_id", pa.int64()), ("score", pa.float64())])


def _scorer(shared):
    def run(batches):
        model: Model = shared.value
        lex = Lexicon(model.weights, model.fuzzy, model.max_edits)
        for batch in (p for whole in batches for p in pieces(whole, 1)):
            x = np.array([context_features(t.as_py() or "", lex) for t in batch.column(1)]).reshape(-1, N_FEATURES)
            z = x @ model.w[:-1] + model.w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], schema=_SCORE)

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id_col, score)``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _scorer(shared), "_id long, score double").withColumnRenamed("_id", id_col)


def not_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score under ``threshold``."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m: Model = shared.value
        lex = Lexicon(m.weights, m.fuzzy, m.max_edits)
        for batch in (p for whole in batches for p in pieces(whole, at)):
            x = np.array([context_features(t.as_py() or "", lex) for t in batch.column(at)]).reshape(-1, N_FEATURES)
            z = x @ m.w[:-1] + m.w[-1]
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``(id_col, held_out, score, predicted)``; ids whose crc32 is divisible by 5 are held out of learning."""
    out_of = fold(F.col(id_col), 5) == 0
    model = train(docs, labels, out_of, id_col, text_col, sample=sample)
    return score(docs, model, id_col, text_col).select(
        id_col, out_of.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
