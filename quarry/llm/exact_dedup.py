"""Exact dedup over an extendible-hash index (operator 7), in DataFrame functions only.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]``
is replaced by one space; null counts as empty. Of equal texts the row with the
smallest id stays.

Method. The index is a table of entries in shared files, one per different
text: bucket, 64-bit key, place in the key's chain, SHA-256, smallest id, rows, text.
1. Keys are counted by their leading bits. A directory over these bits points to
   buckets: one that holds more than ``capacity`` keys splits by its next bit,
   and the directory doubles where a bucket uses all its bits.
2. Every row finds its bucket, a key range, through the directory and goes to the
   bucket's owner task with its text. There rows with one key form a chain, whose
   entries come from comparing whole texts, byte by byte; the owner writes
   them in key order.
3. ``match_batch`` looks a later batch up in the stored index: bucket by the
   directory, chain by the key, entry by the text. The first batch isn't read again.

Scale. Texts are shuffled once. Rows of keys that stand in more than ``HOT``
rows are first reduced to one per text and input split, so a group with a third
of all rows is an entry per split for its owner. The directory has at most ``2 ** MAX_BITS``
slots at any input; beyond ``capacity << MAX_BITS`` texts raise ``max_bits``.

Edge cases. A null id follows all others; when rows repeat with one id and one
text, exactly one of them stays. Empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import GAP, Scratch, attach, id_or_last, id_or_null, sent_whole

CAPACITY = 5_000     # keys of a bucket
MAX_BITS = 16        # of the directory
HOT = 1_000          # rows with one key that are reduced before they reach the owner


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def directory(counts: dict[int, int], capacity: int = CAPACITY, max_bits: int = MAX_BITS) -> list[tuple[int, int, int]]:
    """Buckets ``(first slot, depth, entries)`` for entry counts by slot of ``max_bits`` bits.

    Starts with one bucket of depth 0 and splits what is over capacity."""
    size = 1 << max_bits
    sums = [0] * (size + 1)
    for s in range(size):
        sums[s + 1] = sums[s] + counts.get(s, 0)
    done, todo = [], [(0, 0)]
    while todo:
        first, depth = todo.pop()
        width = size >> depth
        held = sums[first + width] - sums[first]
        if held > capacity and depth < max_bits:
            todo += [(first + width // 2, depth + 1), (first, depth + 1)]
        else:
            done.append((first, depth, held))
    return sorted(done)


def _slot(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def _slots(buckets: DataFrame, max_bits: int) -> DataFrame:
    """The directory, one row per slot: ``(slot, bucket)``, at most ``2 ** max_bits`` rows."""
    last = F.expr(f"bucket + shiftright({1 << max_bits}, depth) - 1")
    return F.broadcast(buckets.select(F.explode(F.sequence(F.col("bucket"), last)).alias("slot"), "bucket"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    source = docs.select(id_or_last(id_col).alias("_id"), normalised(F.col(text_col)).alias("norm"))
    return source.withColumn("key", key(F.col("norm")))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                max_bits: int = MAX_BITS, hot: int = HOT, key: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, index, buckets)``: key and SHA-256 of every row; the written
    index ``(bucket, key, chain, sha, keep, n, norm)``; its directory ``(bucket, depth, entries)``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = _keyed(docs, id_col, text_col, key)
    rows = scratch.write(source.select("_id", "key", F.sha2("norm", 256).alias("sha")), "exact-rows")
    keys = scratch.write(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    counts = {x["slot"]: x["count"] for x in keys.groupBy(_slot("key", max_bits).alias("slot")).count().collect()}  # 2**max_bits rows at most
    buckets = spark.createDataFrame(directory(counts, capacity, max_bits), "bucket int, depth int, entries long")
    crowded = scratch.write(keys.where(F.col("n") > hot).select("key"), "exact-crowded")
    placed = source.withColumn("slot", _slot("key", max_bits)).join(_slots(buckets, max_bits), "slot").drop("slot")
    single = placed.withColumn("n", F.lit(1).cast("long"))
    if not crowded.isEmpty():
        side = sent_whole(crowded, F.lit(8))
        reduced = (placed.join(side, "key", "left_semi").withColumn("split", F.spark_partition_id())
                   .groupBy("split", "bucket", "key", "norm").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("n")).drop("split"))
        single = single.join(side, "key", "left_anti").unionByName(reduced)
    # the owner of a bucket: equal keys chain, equal texts of a chain are one entry
    entries = single.repartition("bucket").groupBy("bucket", "key", "norm").agg(F.min("_id").alias("keep"), F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("norm")) - 1
    index = scratch.write(entries.select("bucket", "key", place.alias("chain"), F.sha2("norm", 256).alias("sha"), "keep", "n", "norm"),
                          "exact-index")
    scratch.drop(keys, crowded)
    return rows, index, buckets


def match_batch(docs: DataFrame, index: DataFrame, buckets: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """A later batch against the stored index: ``(id_col, keep_id, found)``; ``keep_id`` is the
    smallest id the index has for the row's text, ``found`` whether it has the text at all."""
    batch = _keyed(docs, id_col, text_col, key).withColumn("slot", _slot("key", max_bits)).join(_slots(buckets, max_bits), "slot")
    entry = index.select("bucket", "key", "norm", "keep")
    return batch.join(entry, ["bucket", "key", "norm"], "left").select(
        id_or_null("_id").alias(id_col), id_or_null("keep").alias("keep_id"), F.col("keep").isNotNull().alias("found"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per input row: ``(id_col, keep_id, group_size, kept, text_sha256)``."""
    rows, index, _ = build_index(docs, id_col, text_col, capacity)
    # one of the rows that repeat with an id; numbered by id, apart from the join, which may then split a large group
    rows = rows.withColumn("one", F.row_number().over(Window.partitionBy("key", "sha", "_id").orderBy(F.lit(1))) == 1)
    return rows.join(index.select("key", "sha", "keep", "n"), ["key", "sha"]).select(
        id_or_null("_id").alias(id_col), id_or_null("keep").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("_id") == F.col("keep")) & F.col("one")).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows, with all their columns, that stay: one of each group of equal texts."""
    scratch = Scratch(docs.sparkSession)
    rows, index, _ = build_index(docs, id_col, text_col, capacity)
    copies = scratch.write(rows.join(index.where("n > 1").select("key", "sha", "keep"), ["key", "sha"]), "exact-copies")
    gone = copies.where("_id != keep").select("_id", "key", "sha").distinct()
    # rows that repeat with the id that stays; there are hardly ever any
    ties = scratch.write(copies.where("_id = keep").groupBy("key", "sha").agg(F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("key", "sha"), "exact-ties")
    names = [f"c{i}" for i in range(len(docs.columns))]  # free of clashes
    d = docs.toDF(*names)
    norm = normalised(F.col(names[docs.columns.index(text_col)]))
    d = d.select(*names, id_or_last(names[docs.columns.index(id_col)]).alias("_id"), norm.alias("_norm"))
    d = d.select(*names, "_id", F.xxhash64("_norm").alias("key"), F.sha2("_norm", 256).alias("sha"))
    d = attach(d, gone, ["_id", "key", "sha"], "left_anti")
    if ties.limit(1).count():
        tied = attach(d, ties, ["key", "sha"], "left_semi")
        d = attach(d, ties, ["key", "sha"], "left_anti").unionByName(tied.dropDuplicates(["key", "sha"]))
    return d.select(*names).toDF(*docs.columns)


def oracle(table: str = "documents") -> str:
    """The same result in DuckDB SQL, for tables with unique ids."""
    return f"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h FROM {table})
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM n"""
