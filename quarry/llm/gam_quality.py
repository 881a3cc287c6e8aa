"""Quality classifier (operator 2): a generalised additive model with pairwise interactions.

Method. Shape features of the text (see text_features) are binned at quantiles.
Boosting goes round the features: each step fits a shallow tree of at most
three leaves on one feature's bins to the logistic gradients and adds a small
part of it to that feature's lookup table. Then the pairs with the strongest
rest are found and boosted the same way with trees of one cut on each side. A
text's score is the sigmoid of the intercept plus one table entry for each
feature and pair, as array additions.

Scale. Learning takes at most ``sample`` labelled rows, chosen by a hash of the
id, whatever the corpus holds; their features (a few MB) are fitted on the
driver. Scoring is a map over rows without a shuffle; the tables are a few KB.

Edge cases. Null and empty texts have the same all-zero features and get a
score. Without usable labels the score is 0; with one kind only it is that
kind's smoothed share. Null ids are scored as well. Repeated rows are kept;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ship_package
from quarry.llm.labels import fold, labelled_sample
from quarry.llm.text_features import NAMES, features

SAMPLE = 20_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, RIDGE, MIN_HESSIAN = 0.15, 1.0, 2.0


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)        # bin edges of each feature
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)       # coarser edges, for pairs
    pair_tables: list[np.ndarray] = field(default_factory=list)  # flat PAIR_BINS x PAIR_BINS

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, f], side="right")]
        if self.pairs:
            b = _bins(x, self.coarse)
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                z += t[b[:, i] * PAIR_BINS + b[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def _quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, at most bins - 1."""
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))
    values = np.unique(x)
    at = np.searchsorted(values, cuts, side="right")
    at = np.unique(at[at < len(values)])
    return (values[at - 1] + values[at]) / 2 if len(at) else np.zeros(0)


def _leaf(g, h):
    return -g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of each bin for a tree of up to three leaves on the bins' order."""
    parts = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, 0)
        for k, (lo, hi) in enumerate(parts):
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
            gain = np.where((hl >= MIN_HESSIAN) & (hs - hl >= MIN_HESSIAN), _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs), 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), k, lo + 1 + int(gain.argmax()))
        if best[1] is None:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut on each side of a bin grid: its gain and the four leaves' values by cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = tg - a_g - b_g - c_g, th - a_h - b_h - c_h
    gain = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h) - _gain(tg, th)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty(g.shape)
    out[: i + 1, : j + 1] = _leaf(a_g[i, j], a_h[i, j])
    out[: i + 1, j + 1:] = _leaf(b_g[i, j], b_h[i, j])
    out[i + 1:, : j + 1] = _leaf(c_g[i, j], c_h[i, j])
    out[i + 1:, j + 1:] = _leaf(d_g[i, j], d_h[i, j])
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of lookup tables, first per feature, then per pair."""
    if not len(y):
        return Gam(-30.0)
    p = (y.sum() + 0.5) / (len(y) + 1)
    gam = Gam(float(np.log(p / (1 - p))))
    if not 0 < y.sum() < len(y):
        return gam
    gam.edges = [_quantile_edges(x[:, f], BINS) for f in range(x.shape[1])]
    gam.tables = [np.zeros(len(e) + 1) for e in gam.edges]
    bins = _bins(x, gam.edges)
    z = np.full(len(y), gam.intercept)

    def slopes():
        q = 1 / (1 + np.exp(-z))
        return q - y, q * (1 - q)

    for _ in range(ROUNDS):
        for f, t in enumerate(gam.tables):
            if len(t) > 1:
                g, h = slopes()
                step = RATE * _tree(np.bincount(bins[:, f], g, len(t)), np.bincount(bins[:, f], h, len(t)))
                t += step
                z += step[bins[:, f]]
    gam.coarse = [_quantile_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cells = _bins(x, gam.coarse)
    g, h = slopes()

    def grid(i, j, g, h):
        code, n = cells[:, i] * PAIR_BINS + cells[:, j], PAIR_BINS * PAIR_BINS
        shape = (PAIR_BINS, PAIR_BINS)
        return _cross(np.bincount(code, g, n).reshape(shape), np.bincount(code, h, n).reshape(shape))

    ranked = sorted(((grid(i, j, g, h)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    gam.pairs = [(i, j) for _, i, j in ranked[:PAIRS]]
    gam.pair_tables = [np.zeros(PAIR_BINS * PAIR_BINS) for _ in gam.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(gam.pairs, gam.pair_tables, strict=True):
            g, h = slopes()
            step = RATE * grid(i, j, g, h)[1].ravel()
            t += step
            z += step[cells[:, i] * PAIR_BINS + cells[:, j]]
    return gam


def _feature_rows(batches):
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])
    for batch in batches:
        x = features(batch.column(0))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x), schema.field(1).type)], schema=schema)


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label: str = "quality", sample: int = SAMPLE) -> Gam:
    """Learns from at most ``sample`` labelled rows outside ``held_out``."""
    ship_package(docs.sparkSession)
    rows = labelled_sample(labels, label, held_out, sample, id_col)
    own = docs.join(F.broadcast(rows), F.col(id_col).cast("long") == F.col("_lid")).select(F.col(text_col).alias("_text"), F.col("y"))
    got = own.mapInArrow(_feature_rows, "y int, x array<double>").toPandas()  # bounded by `sample`
    x = np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, len(NAMES)))
    y = got["y"].to_numpy(dtype=float)
    order = np.lexsort((*x.T, y))  # the same sums whatever order the rows came in
    return fit(x[order], y[order])


_SCORE = pa.schema([("_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, gam: Gam, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id_col, score)``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gam)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(features(batch.column(1))))], schema=_SCORE)

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, "_id long, score double").withColumnRenamed("_id", id_col)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``(id_col, held_out, score, predicted)``; ids whose crc32 leaves 2 modulo 4 are held out of learning."""
    out_of = fold(F.col(id_col), 4) == 2
    gam = train(docs, labels, out_of, id_col, text_col, sample=sample)
    return score(docs, gam, id_col, text_col).select(
        id_col, out_of.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
