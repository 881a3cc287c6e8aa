"""Helpers shared by the operators of this subpackage.

Null handling common to all of them: a null text counts as an empty text; a
null id sorts after every other id and all rows without an id count as one
document for "smallest id" rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import fresh_path, ship_package  # noqa: F401

#: fixed values: the six ASCII white-space characters of the contracts, [\x20\x09-\x0D]
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: stands for a null id: no id is larger
NO_ID = 2**63 - 1

#: largest measured side that is sent whole to every task, in bytes and rows
BROADCAST_BYTES = 24 << 20
BROADCAST_ROWS = 400_000


class Scratch:
    """Tables written once below the shared checkpoint folder.

    ``write`` cuts the lineage (the files survive a lost executor); ``drop``
    deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = fresh_path(self.spark, tag)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch_path = path  # keeps the frame's id alive with its path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self._paths.pop(id(t), None)
            if path:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def id_or_last(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("long"), F.lit(NO_ID))


def id_or_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != NO_ID, c)


def row_tag(text: Column) -> Column:
    """64-bit tag that tells apart rows with one id and different texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a side table with one small row per key to a table with texts.

    Both sides are shuffled by the key and the side table is hashed, so no
    text is sorted; the plan is the same at every size."""
    return left.join(right.hint("shuffle_hash"), on, how)


def sent_whole(df: DataFrame, size: Column) -> DataFrame:
    """A written side table for a join on few, uneven keys: broadcast if its
    counted rows and bytes (``size`` per row) are under the bound, else as it is."""
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and b + 32 * n <= BROADCAST_BYTES else df


def n_buckets(spark: SparkSession, factor: float = 1) -> int:
    """Buckets of a hash range: as many as shuffle partitions, times ``factor``."""
    return max(1, int(int(spark.conf.get("spark.sql.shuffle.partitions")) * factor))
