"""Relational core: counts, presence, distinct, group counts, top-k, set ops.

Every function accepts an optional ``weight`` column. When given, each input
row stands for ``weight`` original rows, which lets a caller pre-aggregate a
big fact table on a narrow key *before* a join (map-side combine) and still
ask for exact row counts afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import present


def _n(weight: str | None) -> Column:
    return F.sum(F.col(weight)).cast("long") if weight else F.count(F.lit(1))


def count_rows(df: DataFrame, weight: str | None = None, name: str = "n_rows") -> DataFrame:
    """Number of records (not text lines) as a one-row table."""
    return df.agg(F.coalesce(_n(weight), F.lit(0).cast("long")).alias(name))


def count_present(df: DataFrame, col: str, weight: str | None = None,
                  name: str = "n_present") -> DataFrame:
    """Rows whose ``col`` holds a value (not null, not empty)."""
    w = F.col(weight) if weight else F.lit(1)
    return df.agg(F.coalesce(F.sum(F.when(present(col), w).otherwise(0)), F.lit(0)).cast("long").alias(name))


def filter_present(df: DataFrame, col: str) -> DataFrame:
    return df.where(present(col))


def filter_equal(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Half-open range ``lo <= col < hi``."""
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def filter_in(df: DataFrame, col: str, values: DataFrame | Sequence) -> DataFrame:
    """Membership in a list or in the first column of another table.

    A table argument becomes a left-semi join, so it may be of any size and
    may repeat values; Spark broadcasts it only when its measured size is under
    the threshold, and otherwise splits a hot value of ``col``.
    """
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias("__v"))
        return df.join(other, F.col(col) == F.col("__v"), "left_semi")
    return df.where(F.col(col).isin(list(values)))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct present values of ``col`` (code-point order)."""
    return df.where(present(col)).select(col).distinct().orderBy(col)


def group_count(df: DataFrame, col: str, weight: str | None = None,
                name: str = "count") -> DataFrame:
    """Rows per present value of ``col``, ordered by value.

    ``groupBy`` plans a partial aggregate before the exchange, so a hot value
    costs one row per map task in the shuffle, not one row per record.
    """
    return (df.where(present(col)).groupBy(col).agg(_n(weight).alias(name))
            .orderBy(col))


def top_k_groups(df: DataFrame, col: str, k: int = 10, weight: str | None = None,
                 name: str = "count") -> DataFrame:
    """The ``k`` largest groups; ties broken by the value, ascending.

    One ``orderBy(...).limit(k)`` so Spark plans TakeOrderedAndProject: every
    task keeps only its own top ``k`` and the driver merges ``k`` per task.
    """
    counts = df.where(present(col)).groupBy(col).agg(_n(weight).alias(name))
    return counts.orderBy(F.desc(name), F.asc(col)).limit(k)


def intersect_sorted(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> DataFrame:
    """Present values found in both inputs, sorted once at the end.

    Both sides are de-duplicated first (partial aggregates), so a value that
    fills a third of one input is one row per task before the semi-join.
    """
    col_b = col_b or col
    left = a.where(present(col)).select(F.col(col)).distinct()
    right = b.where(present(col_b)).select(F.col(col_b).alias(col)).distinct()
    return left.intersect(right).orderBy(col)


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def rows_head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows by an explicit order (``limit`` alone is not ordered)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
