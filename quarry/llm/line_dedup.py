"""Line dedup over levelled sorted runs (operator 1), in DataFrame functions only.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
in lower case. Keys of at least ``min_chars`` code points that stand in two or
more documents lose all their lines except in the document with the smallest id.

Method. ``LineRuns`` keeps the keys seen so far (128-bit hashes, with the first
document that has them) in sorted runs on levels: bucketed tables, sorted by
hash in each bucket. A batch of documents is reduced to one row per key, merge
joined against the runs (no run is shuffled or sorted again) and what is new
becomes a run of level 0. When a level holds ``fanout`` runs, they are merged
into one run of the next level. Batches come by rising id, so the document that
a run names is the smallest.

Scale. Keys are aggregated map-side before the shuffle; a line in a third of
all documents is one row per task. Only keys that lose lines are joined back to
the lines; they come from a written table, so adaptive execution can split a
frequent one. Texts are shuffled once, to meet the positions of their lost lines.

Edge cases. A null or empty text is one empty line. Rows without an id count as
one document that follows all others; rows with the same id are one document.
Lines that repeat inside the keeping document stay. Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import NO_ID, WHITE, Scratch, attach, id_or_last, id_or_null, n_buckets, row_tag
from quarry.session import fresh_path

MIN_CHARS = 10
FANOUT = 3
BATCHES = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trimmed(line: Column) -> Column:
    """Without white space at both ends; most lines have none there and are left as they are."""
    ends = [F.left(line, F.lit(1)).isin(*WHITE), F.right(line, F.lit(1)).isin(*WHITE)]
    return F.when(ends[0] | ends[1], F.btrim(line, F.lit(WHITE))).otherwise(line)


def lower_ascii(line: Column) -> Column:
    """A-Z in lower case and nothing else. In pure ASCII that is what lower() does;
    other lines replace the capitals they have."""
    one_by_one = line
    for big, small in zip(UPPER, LOWER, strict=True):
        one_by_one = F.replace(one_by_one, F.lit(big), F.lit(small))
    return (F.when(F.octet_length(line) == F.char_length(line), F.lower(line))
            .when(line.rlike("[A-Z]"), one_by_one).otherwise(line))


def line_key(line: Column) -> Column:
    return lower_ascii(trimmed(line))


def lines_of(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(_id, _tag, pos, key)`` of every line whose key is long enough; key is the hash."""
    d = docs.select(id_or_last(id_col).alias("_id"), row_tag(F.col(text_col)).alias("_tag"),
                    F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("pos", "line"))
    # lower case doesn't change the length: it is left for the lines that are long enough
    d = d.where(F.char_length("line") >= min_chars)
    d = d.select("_id", "_tag", "pos", trimmed(F.col("line")).alias("line")).where(F.char_length("line") >= min_chars)
    # never null, and declared so: a join on a nullable key would filter on it, computing every key twice
    return d.select("_id", "_tag", "pos", F.coalesce(F.unhex(F.md5(lower_ascii(F.col("line")))), F.lit(b"")).alias("key"))


class LineRuns:
    """Levelled sorted runs of ``(key, first)``: line hash and first document."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or n_buckets(spark)
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.select("key", "first").repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
         .option("path", fresh_path(self.spark, "line-run")).saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in self.levels for n in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Merge-anti-joins a batch's keys ``(key, first, last)`` against the runs and adds what is new.

        Returns the batch's keys that lose lines, ``(key, first)``: those that a
        run has, with its document, and new ones with two or more documents.
        The batch must be a written table."""
        fresh, lost = batch, []
        for run in self.runs():
            lost.append(batch.select("key").join(run.hint("merge"), "key").select("key", "first"))
            fresh = fresh.join(run.hint("merge"), "key", "left_anti")
        lost.append(fresh.where("last > first").select("key", "first"))
        out = lost[0]
        for x in lost[1:]:
            out = out.unionByName(x)
        out = Scratch(self.spark).write(out, "line-lost")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(fresh))
        self._compact()
        return out

    def _compact(self) -> None:
        at = 0
        while at < len(self.levels):
            if len(self.levels[at]) >= self.fanout:
                names = self.levels[at]
                merged = self.spark.table(names[0])
                for n in names[1:]:
                    merged = merged.unionByName(self.spark.table(n))  # runs share no key
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(self._write(merged))
                self.levels[at] = []
                for n in names:
                    self._drop(n)
            at += 1

    def close(self) -> None:
        """Drops all runs."""
        for level in self.levels:
            for n in level:
                self._drop(n)
        self.levels = []


def lost_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """Written table ``(key, first)`` of the keys that lose lines outside document ``first``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    ids = id_or_last(id_col)
    shares = [k / batches for k in range(1, batches)]
    cuts = docs.select(ids.alias("i")).where(F.col("i") != NO_ID).approxQuantile("i", shares, 0.02) if shares else []
    edges = sorted({int(c) for c in cuts})
    runs, lost = LineRuns(spark, fanout), None
    for lo, hi in zip([None, *edges], [*edges, None], strict=True):
        part = docs
        if lo is not None:
            part = part.where(ids > lo)
        if hi is not None:
            part = part.where(F.col(id_col) <= hi)  # a plain range: the scan skips row groups
        keys = scratch.write(
            lines_of(part, id_col, text_col, min_chars).groupBy("key")
            .agg(F.min("_id").alias("first"), F.max("_id").alias("last")), "line-keys")
        x = runs.add(keys)
        scratch.drop(keys)
        lost = x if lost is None else lost.unionByName(x)
    # a key can be lost in several batches; its first document is the same
    out = scratch.write(lost.distinct(), "line-lost")
    runs.close()
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row per input row: ``(id_col, n_lines, n_dropped, kept_text)``."""
    spark = docs.sparkSession
    lost = lost_keys(docs, id_col, text_col, min_chars, batches, fanout)
    drops = Scratch(spark).write(
        lines_of(docs, id_col, text_col, min_chars).join(lost, "key").where(F.col("_id") > F.col("first"))
        .groupBy("_id", "_tag").agg(F.collect_set("pos").alias("drops")), "line-drops")
    src = docs.select(id_or_last(id_col).alias("_id"), row_tag(F.col(text_col)).alias("_tag"),
                      F.coalesce(text_col, F.lit("")).alias("_text"))
    d = attach(src, drops, ["_id", "_tag"])
    d = d.select("_id", "_text", "drops", F.split("_text", "\n").alias("lines"))
    # array_except hashes: its cost is linear in the lines, whatever is dropped
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.when(F.col("drops").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return d.select(id_or_null("_id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
                    F.when(F.col("drops").isNull(), F.lit(0)).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
                    kept.alias("kept_text"))


def oracle(table: str = "documents") -> str:
    """The digests of the same result in DuckDB SQL, for tables with unique ids."""
    return f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {table}),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
m AS (SELECT *, length(key) >= {MIN_CHARS} AND doc_id > min(doc_id) OVER (PARTITION BY key) AS drop_it FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it), '')) AS kept_sha256 FROM m GROUP BY doc_id"""
