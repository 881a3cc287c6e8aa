"""Global 0-based row positions without a single-partition window.

``row_number().over(Window.orderBy(k))`` moves every row into one task. Here
each partition counts its rows, the per-partition counts (one row per
partition) become offsets, and a row's position is its partition's offset
plus its place inside the partition. Cost: one write and two reads of the
positioned rows; ``num_partitions`` offsets travel as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import written_table

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the in-partition position in the low 33 bits


def with_positions(df: DataFrame) -> DataFrame:
    """Add ``__pid`` (partition) and ``__pos`` (place in partition) in current order."""
    return (df.withColumn("__pid", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))


def _finish(s: DataFrame, name: str) -> tuple[DataFrame, int]:
    # one row per partition reaches the driver
    counts = dict((r["__pid"], r["__n"]) for r in
                  s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).collect())
    if not counts:
        return s.withColumn(name, F.lit(None).cast("long")).drop("__pid", "__pos"), 0
    # partition ids are dense, so the offsets form an array indexed by id:
    # an O(1) lookup per row even with tens of thousands of partitions
    offsets, total = [], 0
    for pid in range(max(counts) + 1):
        offsets.append(total)
        total += counts.get(pid, 0)
    off = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("__pid") + 1)
    return (s.withColumn(name, (off + F.col("__pos")).cast("long"))
            .drop("__pid", "__pos"), total)


def row_index(df: DataFrame, order: Sequence[str] | None = None, name: str = "idx",
              num_partitions: int | None = None, with_total: bool = False):
    """0-based position of every row.

    ``order`` given: position in that order (keys should be unique for a
    stable answer); the data is range-partitioned and sorted. ``order``
    omitted: position in the current partition order, e.g. file order right
    after a text scan. The positioned rows are written once to the shared
    folder, so the counting pass and the final pass read identical rows (also
    after a lost executor) and the sort is not repeated.

    Returns the indexed DataFrame, or ``(DataFrame, row_count)`` with
    ``with_total``.
    """
    spark = df.sparkSession
    if order:
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = written_table(with_positions(df), "row-index")
    out, total = _finish(placed, name)
    out._written_path = placed._written_path
    return (out, total) if with_total else out
