"""Line renderers and writers.

``to_csv_lines`` reproduces the text the original helper printed: values
joined by commas, never quoted (a comma inside a value stays as it is),
``str()`` of each value, lists as Python prints them (``['a', 1.5, None]``),
nulls as ``None``, doubles with the shortest round-trip digits
(``functions.py_value``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import py_value
from quarry.session import ship_package


def to_csv_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """One unquoted comma-joined text line per row, column ``line``."""
    return df.select(F.concat_ws(",", *[py_value(f"`{f.name}`", f.dataType) for f in df.schema.fields]).alias(name))


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-column string table as text files (one part file per task)."""
    df.write.mode(mode).text(path)


def headed(lines: DataFrame, header: str) -> DataFrame:
    """One-column lines with ``header`` before those of every partition, so on top of every part file."""
    ship_package(lines.sparkSession)
    return lines.mapInArrow(_with_header(header), "value string")


def _with_header(header: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays(b.columns, ["value"])
    return run


def write_sorted_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    """Write a column sorted: range-partitioned, so part files follow the order."""
    df.select(F.col(col).cast("string").alias("value")).orderBy("value").write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              null_value: str = "") -> None:
    """Header CSV; ``null_value`` other than ``''`` keeps nulls and ``''`` apart."""
    (df.write.mode(mode).option("header", header).option("escape", '"')
     .option("nullValue", null_value).csv(path))


def to_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """The key to value map of a table in long form: one row ``(key, value)`` per key.

    Duplicate keys keep the largest value, null keys are left out. A map in
    one row would gather the whole table in one task, so look-ups are joins on
    ``key``, at any size."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
