"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(row_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % k


def labelled_sample(labels: DataFrame, label: str, held_out: Column, limit: int, id_col: str = "doc_id") -> DataFrame:
    """``(_lid, y)`` of at most ``limit`` labelled rows outside the held-out fold.

    Rows without id or label are left out; an id that repeats counts as 1 if
    any of its labels is. The choice is by a hash of the id, so it is the same
    on every run and spread over the table."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out)
            .groupBy(F.col(id_col).cast("long").alias("_lid")).agg(F.max(F.col(label).cast("int")).alias("y"))
            .orderBy(F.xxhash64("_lid"), "_lid").limit(limit))
