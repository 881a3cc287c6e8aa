"""File readers: header CSV, text lines, ``::`` records, ragged lines.

All readers take an explicit schema (no inference pass over the data) and
return lazy DataFrames, so a later ``select`` prunes what the CSV parser
materialises and a later filter runs inside the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.indexing import with_positions


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None, header: bool = True,
             mode: str = "DROPMALFORMED", multiline: bool = False,
             exact_drops: bool | None = None, null_value: str = "") -> DataFrame:
    """Header CSV with quoted fields; malformed records dropped by default.

    Without a ``schema`` every column is a string named by the header (no
    type inference pass).

    ``multiline`` lets a quoted field span lines. A file is then still read by
    as many tasks as it has splits (``csv_records``); such records, but no
    lines, are put together across splits. Always exact drops.
    With DROPMALFORMED, Spark's CSV column pruning parses only the selected
    columns, so a record with a wrong number of fields would still be counted
    (a bare row count parses none). ``exact_drops`` (default: on under
    DROPMALFORMED) turns CSV column pruning off for this read, so every count
    and projection drops such records; the session's settings are left alone.
    A value that doesn't fit its column's type drops the record wherever that
    column is read.
    With the default ``null_value`` an empty field reads as null (as the
    original DataFrame code saw it); a file written with another null marker
    keeps ``''`` and null apart.
    """
    if multiline:
        return _scan_multiline(spark, path, schema, header, mode.upper(), null_value)
    if exact_drops is None:
        exact_drops = mode.upper() == "DROPMALFORMED"
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if exact_drops:
        reader = reader.option("columnPruning", False)
    return (reader
            .option("header", header).option("mode", mode).option("escape", '"')
            .option("nullValue", null_value)
            .csv(path))


BAD = "__malformed"


def _scan_multiline(spark: SparkSession, path: str, schema: StructType | str | None, header: bool, mode: str, null_value: str) -> DataFrame:
    """Records of all lines parsed one by one; those that don't fit the schema are dropped, nulled or raise, by ``mode``."""
    from quarry.sources.csv_records import csv_records

    if schema is None:  # names from the first record, all columns strings
        schema = spark.read.option("header", header).option("multiLine", True).option("escape", '"').csv(path).schema
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    records = csv_records(spark, path, header)
    options = {"escape": '"', "nullValue": null_value, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    text = F.coalesce("value", F.lit('"'))  # too long: malformed
    parsed = records.select(F.from_csv(text, _ddl(fields.add(BAD, "string")), options).alias("r"))
    if mode == "FAILFAST":
        failed = F.raise_error(F.concat(F.lit("malformed CSV record: "), F.substring(F.col("r")[BAD], 1, 200)))
        parsed = parsed.where(F.when(F.col("r")[BAD].isNull(), F.lit(True)).otherwise(failed.cast("boolean")))
    elif mode == "DROPMALFORMED":
        parsed = parsed.where(F.col("r")[BAD].isNull())
    return parsed.select("r.*").drop(BAD)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def skip_header(lines: DataFrame) -> DataFrame:
    """Drop the first line of every file (and only that line).

    The first line of a file is the first row of the split that starts at
    byte 0 of that file; per file, the smallest position among such rows is
    found by a partial aggregate and removed by an anti-join.
    """
    meta = lines.select("*", F.col("_metadata.file_path").alias("__file"),
                        F.col("_metadata.file_block_start").alias("__start"))
    pos = with_positions(meta).withColumn(
        "__key", F.col("__pid").cast("long") * F.lit(1 << 33) + F.col("__pos"))
    heads = (pos.where(F.col("__start") == 0).groupBy("__file")
             .agg(F.min("__key").alias("__key")))
    return (pos.join(heads, ["__file", "__key"], "left_anti")
            .drop("__file", "__start", "__pid", "__pos", "__key"))


def parse_delimited(lines: DataFrame, names: Sequence[str], types: Sequence[str],
                    sep: str = "::", lenient: bool = False, value: str = "value") -> DataFrame:
    """Split each line on the literal ``sep`` and cast field ``i`` to ``types[i]``.

    Strict mode uses ``cast`` (under ANSI a bad number fails the job, as
    ``int()`` did); ``lenient`` uses ``try_cast`` and yields null instead.
    Fields past ``len(names)`` are ignored.
    """
    parts = F.split(F.col(value), _literal_regex(sep))
    cols = []
    for i, (n, t) in enumerate(zip(names, types)):
        f = F.trim(F.element_at(parts, i + 1)) if t != "string" else F.element_at(parts, i + 1)
        cols.append((f.try_cast(t) if lenient else f.cast(t)).alias(n))
    return lines.select(*cols)


def parse_ragged(lines: DataFrame, sep: str = ",", key: str = "key", items: str = "items",
                 value: str = "value") -> DataFrame:
    """First field is the key, the remaining fields (file order) the items.

    Columns other than ``value`` (e.g. a line number) are kept."""
    parts = F.split(F.col(value), _literal_regex(sep))
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, F.element_at(parts, 1).alias(key),
                        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias(items))


def parse_csv_line(lines: DataFrame, schema: StructType | str, value: str = "value",
                   null_value: str = "") -> DataFrame:
    """Parse CSV-formatted text lines (quotes honoured) into typed columns."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    opts = {"escape": '"', "nullValue": null_value}
    return lines.select(F.from_csv(F.col(value), ddl, opts).alias("__r")).select("__r.*")


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small driver-side list as a table, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def _literal_regex(sep: str) -> str:
    import re

    return re.escape(sep).replace("\\:", ":")




def file_row_index(lines: DataFrame, name: str = "id") -> DataFrame:
    """0-based line number over all files of a text scan, files in path order.

    Spark packs files into partitions by size, not by name, so a plain
    position index follows no file order. Lines of one split (file, start
    byte) are read by one task in file order, so a line's number is the
    split's offset (lines in all earlier splits, by path then start) plus
    its place inside the split. Only one row per split is aggregated and
    ordered; that table is joined back by broadcast when its counted size is
    under ``session.BROADCAST_ROWS``, else by a sort-merge join. Nothing is
    sorted.
    The positioned lines are written once to the shared folder so both uses
    see the same ids.
    """
    from pyspark.sql import Window

    from quarry.session import bounded_side, written_table

    keyed = written_table(
        lines.select("*", F.col("_metadata.file_path").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__start"),
                     F.monotonically_increasing_id().alias("__mono")), "file-lines")
    splits = keyed.groupBy("__file", "__start").agg(F.min("__mono").alias("__m0"),
                                                    F.count(F.lit(1)).alias("__n"))
    # one row per input split reaches this window
    w = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("__file", "__start", "__m0",
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    offsets = bounded_side(offsets, splits.count())
    return (keyed.join(offsets, ["__file", "__start"])
            .withColumn(name, (F.col("__off") + F.col("__mono") - F.col("__m0")).cast("long"))
            .drop("__file", "__start", "__mono", "__m0", "__off"))
