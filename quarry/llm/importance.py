"""Target-distribution importance resampling (operator 13).

Documents are drawn without replacement, likelier the closer their hashed
n-gram features are to those of a target table. A feature is a run of words;
its bucket is ``crc32 mod buckets``. A bucket's gain is the log ratio, in
thousandths, of its smoothed shares in the target and in the documents; a
document's weight is the floored mean of its features' gains. A Gumbel number
derived from the id is added, and the highest scores are drawn.

Method. Array-scored weights: the gains are one array, a text's features index
it. Exact ranks come from parallel sorting by regular sampling: every task
sorts its rows as a run, rows at regular places of the runs are the sample,
and regular places of the sample are splitters; the segments between two
splitters are exchanged and merged in one task each, and prefix counts of the
segments turn places into ranks. Segments beyond the last rank that is drawn
stay where they are.

Scale. Counts are arrays of ``buckets`` numbers a task, added up in Spark; the
driver gets the summed array, one sampled row of ``PART_ROWS / OVERSAMPLING``
and one count a segment. Keys are (score, id, row), so that equal scores, or
rows that repeat, are split as well.

Edge cases. A null text has no features and weight 0. A null id counts as empty
text in the hash and follows other ids; rows that repeat with one id each get a
score and compete. Empty tables give an empty result, an empty target leaves
the smoothed ratio. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, id_or_last, id_or_null, n_buckets, ship_package
from quarry.operators.indexing import with_positions

#: of lower-cased UTF-8: neither a control nor an ASCII sign
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PART_ROWS = 2_000_000   # rows of a segment, about
OVERSAMPLING = 16       # sampled rows for each segment
SLICE = 1 << 20         # features counted at a time


def features(text: bytes, least: int, most: int) -> tuple[int, list[bytes]]:
    """Number of words, and all runs of ``least`` to ``most`` words."""
    words = WORD.findall(text.lower())  # of bytes, so only A-Z change
    if (least, most) == (1, 1):
        return len(words), words
    return len(words), [b" ".join(words[i: i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def _hashed(feats: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, feats), dtype=np.int64, count=len(feats)) % buckets


def _texts(col: pa.Array) -> Iterator[bytes]:
    for x in col:
        yield x.as_py() or b""


def _count(least: int, most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(buckets, dtype=np.int64), [], 0
        for b in batches:
            for text in _texts(b.column(0)):
                held.append(_hashed(features(text, least, most)[1], buckets))
                size += len(held[-1])
                if size > SLICE:
                    total += np.bincount(np.concatenate(held), minlength=buckets)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])
    return run


def bucket_counts(table: DataFrame, text_col: str, least: int, most: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket."""
    parts = (table.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(_count(least, most, buckets), "bucket int, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, dtype=np.int64)
    for r in parts.collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n, s, t = len(documents), int(documents.sum()), int(target.sum())
    ratio = [(float(b) + 1.0) * (float(s) + n) / ((float(a) + 1.0) * (float(t) + n)) for a, b in zip(documents.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def _weigh(gain: np.ndarray, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_features, weight = [], [], []
            for text in _texts(b.column(1)):
                n, feats = features(text, least, most)
                n_words.append(n)
                n_features.append(len(feats))
                weight.append(int(gain[_hashed(feats, len(gain))].sum()) // len(feats) if feats else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))],
                                             ["id", "n_words", "n_features", "weight"])
    return run


def weighed(docs: DataFrame, gain: np.ndarray, least: int, most: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` of every row."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.when(F.col("id") != 2**63 - 1, F.col("id")).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return (docs.select(id_or_last(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
            .mapInArrow(_weigh(gain, least, most), "id long, n_words long, n_features long, weight long")
            .withColumn("score", F.col("weight") + gumbel))


# ------------------------------------------------------------------ sorting by regular sampling


def sort_keys(score: np.ndarray, row_id: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Byte strings that sort as (score descending, id, row)."""
    sign = np.uint64(1 << 63)
    cols = (~(score.astype(np.uint64) ^ sign), row_id.astype(np.uint64) ^ sign, row.astype(np.uint64) ^ sign)
    return np.ascontiguousarray(np.stack(cols, axis=1).astype(">u8")).view("S24").ravel()


def _segment(splitters: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = sort_keys(*(b.column(n).to_numpy() for n in ("score", "id", "row")))
            place = np.searchsorted(splitters, key, side="left")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int32())], [*names, "segment"])
    return run


def draw(rows: DataFrame, n_rows: int, n_drawn: int, scratch: Scratch, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` (score, id, row, ...) with their exact ``rank`` by score, id and row; null beyond ``n_drawn``."""
    parts = max(n_buckets(scratch.spark), math.ceil(n_rows / part_rows))
    order = [F.desc("score"), "id", "row"]
    runs = scratch.write(with_positions(rows.sortWithinPartitions(*order)), "resampling-runs")
    step = max(1, n_rows // (parts * OVERSAMPLING))
    place = F.col("__pos") + F.pmod(F.xxhash64("__pid"), F.lit(step))  # runs of any length give their share of the sample
    sample = runs.where(place % step == 0).select("score", "id", "row").collect()  # OVERSAMPLING rows a segment, about
    keys = np.sort(sort_keys(*(np.array([r[c] for r in sample], dtype=np.int64) for c in ("score", "id", "row"))))
    splitters = keys[np.linspace(0, len(keys), parts + 1).astype(int)[1:-1]] if len(keys) else keys
    runs = runs.drop("__pid", "__pos")
    dealt = runs.mapInArrow(_segment(splitters, runs.columns), f"{', '.join(f'`{n}` {t}' for n, t in runs.dtypes)}, segment int")
    count = dict.fromkeys(range(len(splitters) + 1), 0) | {r["segment"]: r["count"] for r in dealt.groupBy("segment").count().collect()}
    before = np.concatenate([[0], np.cumsum([count[k] for k in sorted(count)])]).tolist()
    last = next(k for k in sorted(count) if before[k + 1] >= n_drawn)
    offset = F.element_at(F.array(*[F.lit(x).cast("long") for x in before[: last + 1]]), F.col("segment") + 1)
    merged = Window.partitionBy("segment").orderBy(*order)
    rank = offset + F.row_number().over(merged)
    ranked = dealt.where(F.col("segment") <= last).withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return ranked.unionByName(dealt.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))).drop("segment")


def importance_resampling(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, least: int = 1, most: int = 1,
                          buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
                          target_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """One row per document: ``(id_col, n_features, weight, score, rank)``; see the module.

    Of the documents with ``min_words`` words, ``percent`` of 100 get a rank."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    gain = gains(bucket_counts(docs, text_col, least, most, buckets), bucket_counts(target, target_col, least, most, buckets))
    rows = scratch.write(weighed(docs, gain, least, most, seed, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "resampling-scored")
    fit = F.col("n_words") >= min_words
    n = rows.where(fit).count()
    ranked = draw(rows.where(fit), n, percent * n // 100, scratch, part_rows)
    rest = rows.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(id_or_null("id").alias(id_col), "n_features", "weight", "score", "rank")


def oracle(documents: str = "documents", target: str = "benchmark") -> str:
    """The registered query in DuckDB SQL, for tables with unique ids; crc32 is spelled out byte by byte."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda k: list_reduce(list_prepend(k, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, {words} AS w FROM {documents}),
b AS (SELECT {words} AS w FROM {target}),
f AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM d),
g AS MATERIALIZED (SELECT unnest(w) AS word FROM b),
v AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295,
      list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(word), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
      lambda c, x: xor(c >> 8, crc.t[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM f UNION SELECT word FROM g), crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN v USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN v USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM f)::DOUBLE + 10000)
    / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM g)::DOUBLE + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN v USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
r AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM {documents} LEFT JOIN w USING (doc_id)),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM r WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM k) * 10 // 100 THEN place END AS rank
FROM r LEFT JOIN k USING (doc_id)"""
