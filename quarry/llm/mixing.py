"""Mixing sources to target weights (operator 3), in DataFrame functions only.

Sources in code-point order (null last) get the weights 5, 2, 1, 5, 2, 1, ...
and share all words by weight. A target stops at ``MAX_EPOCHS`` times its
source's words; what is over goes to the others by weight until none is above.

Method. Efraimidis-Spirakis sampling: a document's key is ``-ln(u) / w`` with
``u`` from a hash of its id and ``w`` its quality weight. Complete epochs take
every document of the source; the rest of the target takes documents by rising
key until their words, prefix-summed, reach it; the last is taken in part.

Scale. Targets come from one row per source. Rows are range-partitioned by
source and key into buckets of about ``BUCKET_ROWS`` rows, whatever the weights
do to the keys; bucket totals are prefix-summed per source and each bucket is
sorted on its own, so a source with a third of all rows is spread over many
tasks. Where the edges fall doesn't change the result. Texts are not shuffled.

Edge cases. A null text has no words and takes none. A null source is a source
of its own. Rows that repeat (same id, source and words) are separate rows and
tie; which of them is cut is not observable. Empty tables give empty results.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, Scratch, id_or_last, id_or_null, sent_whole

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
BUCKET_ROWS = 50_000
#: characters that lower a document's weight
SYMBOLS = "#*$%&|<>!"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 without symbols, falling with their share of the characters."""
    n = F.length(text)
    symbols = (n - F.length(F.translate(text, SYMBOLS, ""))).cast("double")
    return F.when(n > 0, F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * symbols / n.cast("double"))).otherwise(F.lit(1.0))


def uniform(row_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the id: 52 bits of its md5."""
    text = F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":" + seed))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + 1.0) / F.lit(float(2**52 + 2))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(src, source_size, docs, target)`` from one row per source ``(src, source_size, docs)``.

    In order of cap / weight, a prefix of the sources is capped; the first that
    isn't sets the common rate of all the others.
    """
    whole = lcm(*weights)
    by_name, by_cap = Window.orderBy("src"), Window.orderBy("fill", "src")
    dec = "decimal(38,0)"
    t = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_epochs).withColumn("fill", F.col("cap") * (F.lit(whole) / F.col("w")).cast("long"))
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = (t.withColumn("pos", F.row_number().over(by_cap))
         .withColumn("rest", F.sum("source_size").over(every) - before)
         .withColumn("w_rest", F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))))
    capped = F.col("cap").cast("decimal(20,0)") * F.col("w_rest").cast("decimal(18,0)") <= F.col("rest").cast("decimal(20,0)") * F.col("w").cast("decimal(18,0)")
    t = t.withColumn("free", F.min(F.when(~capped, F.struct("pos", "rest", "w_rest"))).over(every))
    rate = (F.col("w").cast("decimal(18,0)") * F.col("free.rest").cast("decimal(20,0)")).cast(dec).cast("double") / F.col("free.w_rest").cast("double")
    target = F.when(F.col("free").isNull() | (F.col("pos") < F.col("free.pos")), F.col("cap").cast("double")).otherwise(rate)
    return t.select("src", "source_size", "docs", target.alias("target"))


def _source_key(c: Column) -> Column:
    """Sorts by code point, null last; never null itself."""
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def _sample_key(row_id: Column, text: Column, seed: str) -> Column:
    return -F.ln(uniform(row_id, seed)) / quality_weight(F.coalesce(text, F.lit("")))


def _drawn(docs, id_col, text_col, source_col, weights, max_epochs, seed, bucket_rows) -> DataFrame:
    """Per row: source, key, id, size; its source's plan; and ``part``, the words taken beyond complete epochs."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(
        id_or_last(id_col).alias("_id"), _source_key(F.col(source_col)).alias("src"), word_count(F.col(text_col)).alias("size"),
        _sample_key(F.col(id_col), F.col(text_col), seed).alias("key")), "mix-rows")
    aims = scratch.write(targets(rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")),
                                 weights, max_epochs), "mix-aims")
    budget = F.round("target").cast("long")
    plan = aims.select(
        "src", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(F.lit(0)).alias("epochs"),
    ).withColumn("extra", budget - F.col("epochs") * F.col("source_size"))
    n_rows = aims.agg(F.sum("docs")).first()[0] or 0
    placed = scratch.write(rows.repartitionByRange(max(1, -(-n_rows // bucket_rows)), "src", "key", "_id", "size")
                           .withColumn("bin", F.spark_partition_id()), "mix-placed")
    scratch.drop(rows)
    order = Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("src", "bin").agg(F.sum("size").alias("words"))
              .withColumn("start", F.coalesce(F.sum("words").over(order), F.lit(0))).drop("words"))
    within = Window.partitionBy("src", "bin").orderBy("key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    done = (placed.withColumn("upto", F.sum("size").over(within))
            .join(starts.join(plan, "src"), ["src", "bin"])
            .withColumn("upto", F.col("upto") + F.col("start") - F.col("size")))
    return done.withColumn("part", F.least(F.col("size"), F.greatest(F.col("extra") - F.col("upto"), F.lit(0))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: ``(id_col, size, source_size, target, taken)`` in words, repeats counted."""
    return _drawn(docs, id_col, text_col, source_col, weights, max_epochs, seed, bucket_rows).select(
        id_or_null("_id").alias(id_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix itself: every row, with all its columns, as often as it is taken.

    Texts stay whole: of the document that ``mix`` takes in part, a copy is
    taken if the part is at least half of it. Each source keeps one cut in its
    order of keys, so rows are not joined by id."""
    drawn = _drawn(docs, id_col, text_col, source_col, weights, max_epochs, seed, bucket_rows)
    plan = Scratch(docs.sparkSession).write(drawn.groupBy("src", "epochs").agg(
        F.max(F.when((F.col("size") > 0) & (2 * F.col("part") >= F.col("size")), F.struct("key", "_id", "size"))).alias("last")), "mix-plan")
    names = [f"c{i}" for i in range(len(docs.columns))]  # free of clashes
    of = {c: F.col(n) for c, n in zip(docs.columns, names, strict=True)}
    d = docs.toDF(*names).select(*names, _source_key(of[source_col]).alias("src"), F.struct(
        _sample_key(of[id_col], of[text_col], seed).alias("key"), id_or_last(of[id_col]).alias("_id"),
        word_count(of[text_col]).alias("size")).alias("place"))
    d = d.join(sent_whole(plan, F.length("src") + 48), "src")
    taken = F.when(F.col("place.size") > 0, F.col("epochs") + F.coalesce((F.col("place") <= F.col("last")).cast("int"), F.lit(0))).otherwise(F.lit(0))
    return (d.select(*names, F.explode(F.array_repeat(F.lit(1), taken.cast("int"))).alias("_copy")).drop("_copy")).toDF(*docs.columns)


def oracle(table: str = "documents") -> str:
    """The same result in DuckDB SQL."""
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src, coalesce(text, '') AS x FROM {table}),
r AS (SELECT doc_id, src, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  -ln((CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13) AS BIGINT)::DOUBLE + 1) / 4503599627370498.0::DOUBLE)
  / (CASE WHEN length(x) > 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE *
     (length(x) - length(translate(x, '{SYMBOLS}', '')))::DOUBLE / length(x)::DOUBLE) ELSE 1.0::DOUBLE END) AS key FROM d),
s AS (SELECT src, sum(size)::HUGEINT AS source_size FROM r GROUP BY src),
w AS (SELECT *, 3 * source_size AS cap, ([5, 2, 1])[((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT]::HUGEINT AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap * (10 // w), src) AS pos,
  sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap * (10 // w), src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (ORDER BY cap * (10 // w), src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM w),
f AS (SELECT min(pos) AS p, arg_min(rest, pos) AS rest, arg_min(w_rest, pos) AS w_rest FROM o WHERE cap * w_rest > rest * w),
t AS (SELECT src, source_size, CASE WHEN f.p IS NULL OR pos < f.p THEN cap::DOUBLE
  ELSE (w * f.rest)::DOUBLE / f.w_rest::DOUBLE END AS target FROM o, f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::HUGEINT // source_size ELSE 0 END AS epochs FROM t),
u AS (SELECT r.*, source_size, target, epochs, round(target)::HUGEINT - epochs * source_size AS extra,
  sum(size) OVER (PARTITION BY r.src ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS upto FROM r JOIN b USING (src))
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (epochs * size + least(size, greatest(extra - upto, 0)))::BIGINT AS taken FROM u"""
