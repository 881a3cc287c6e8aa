"""Records of CSV files whose quoted fields span lines, one file read by many tasks.

Whether a line starts inside a quoted field depends on all lines before it. A
line is therefore a function of that one bit, and so is a split (the lines that
one task reads): a first scan composes the functions of each split's lines, a
fold over the splits of a file gives the bit that each split starts with, and a
second scan cuts records at their true ends. Only the record that a split's end
cuts is handed on; pieces of such records, two a split at most, are grouped and
put together. Lines are never shuffled.

A quote opens a field only where the field starts, as CSV readers have it; a
doubled quote inside a quoted field is a quote. A record of more than
``MAX_RECORD`` characters (a quote that is never closed) is malformed: it comes
out as null, so that no task gathers more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import bounded_side, ship_package, written_table

MAX_RECORD = 16 << 20

_QUOTED = r'(?:[^"]|"")*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|)(?=,|\Z)'
_OPENS = re.compile(rf'(?:{_FIELD},)*+"{_QUOTED}\Z')                                # outside before, inside after
_STAYS = re.compile(rf'{_QUOTED}(?:\Z|"[^,]*+(?:,{_FIELD})*+,"{_QUOTED}\Z)')        # inside before and after


def inside_after(line: str, inside: bool) -> bool:
    """Whether the next line starts inside a quoted field."""
    if '"' not in line:
        return inside
    return bool((_STAYS if inside else _OPENS).match(line))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Runs of rows of one split: (file, start, rows)."""
    for b in batches:
        file, start = b.column("file"), b.column("start")
        i = 0
        while i < b.num_rows:
            f, s = file[i].as_py(), start[i].as_py()
            same = pc.and_(pc.equal(file.slice(i), f), pc.equal(start.slice(i), s))
            n = pc.index(same, pa.scalar(False)).as_py()
            n = b.num_rows - i if n < 0 else n
            yield f, s, b.slice(i, n)
            i += n


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each split as a function of the bit: what it ends with from outside and from inside."""
    ends: dict[tuple[str, int], list[bool]] = {}
    for f, s, rows in _splits(batches):
        at = ends.setdefault((f, s), [False, True])
        lines = rows.column("value")
        for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
            at[:] = [inside_after(line, x) for x in at]
    cols = list(zip(*((f, s, a, b) for (f, s), (a, b) in ends.items()))) or [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
                                     ["file", "start", "from_out", "from_in"])


_PIECES = "file string, start long, piece int, first boolean, value string"


class _Cutter:
    """Records of one split. Pieces: 0 whole, 1 up to the split's first end, 2 all of a split, 3 from its last start."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.began_inside, self.ended, self.first = inside, False, start == 0
        self.held: list[str] = []
        self.size = 0

    def _take(self) -> str | None:
        text = "\n".join(self.held) if self.size <= MAX_RECORD else None
        self.held, self.size = [], 0
        return text

    def _hold(self, line: str) -> None:
        self.size += len(line) + 1
        if self.size <= MAX_RECORD:
            self.held.append(line)
        else:
            self.held = []

    def add(self, lines: list[str]) -> list[tuple]:
        out = []
        for line in lines:
            if '"' not in line and not self.inside:
                out.append((self.file, self.start, 0, self.first, line))
                self.first, self.ended = False, True
                continue
            self.inside = inside_after(line, self.inside)
            self._hold(line)
            if not self.inside:
                piece = 1 if self.began_inside and not self.ended else 0
                out.append((self.file, self.start, piece, self.first and not piece, self._take()))
                self.first, self.ended = False, True
        return out

    def rest(self) -> list[tuple]:
        if not self.size:
            return []
        return [(self.file, self.start, 2 if self.began_inside and not self.ended else 3, self.first, self._take())]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["file", "start", "piece", "first", "value"])

    now: _Cutter | None = None
    for f, s, rows in _splits(batches):
        if now is None or (now.file, now.start) != (f, s):
            if now is not None:
                yield batch(now.rest())
            now = _Cutter(f, s, rows.column("inside")[0].as_py())
        yield batch(now.add(rows.column("value").to_pylist()))
    if now is not None:
        yield batch(now.rest())


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(value)``: one row per record, line breaks inside quotes kept; blank lines left out.

    ``header`` drops the first record of every file. A record that is too long is null."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    ends = written_table(lines.mapInArrow(_functions, "file string, start long, from_out boolean, from_in boolean"), "csv-splits")
    # a row a split; the splits of a file are folded in order
    in_order = ends.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "from_out", "from_in"))).alias("s"))
    none = F.array().cast("array<struct<start: bigint, inside: boolean>>")
    folded = F.aggregate("s", F.struct(F.lit(False).alias("now"), none.alias("done")), lambda a, x: F.struct(
        F.when(a["now"], x["from_in"]).otherwise(x["from_out"]).alias("now"),
        F.concat(a["done"], F.array(F.struct(x["start"].alias("start"), a["now"].alias("inside")))).alias("done")))["done"]
    states = written_table(in_order.select("file", F.inline(folded)), "csv-states")
    known = bounded_side(states, states.count())
    # the second scan must cut the files like the first one
    placed = lines.join(known, ["file", "start"], "left").select(
        "file", "start", "value", F.coalesce("inside", F.raise_error(F.lit("the file's splits have changed between two scans")).cast("boolean")).alias("inside"))
    cut = placed.mapInArrow(_cut, _PIECES)
    keep = ~F.col("first") if header else F.lit(True)
    whole = cut.where((F.col("piece") == 0) & keep).select("value")
    # pieces of a record begin with a 3 and go on to the next 1; null where they are too long together
    pieces = written_table(cut.where("piece > 0"), "csv-pieces")
    from pyspark.sql import Window

    order = Window.partitionBy("file").orderBy("start", "piece")
    chained = pieces.withColumn("record", F.sum((F.col("piece") == 3).cast("int")).over(order))
    size = F.sum(F.coalesce(F.length("value") + 1, F.lit(MAX_RECORD + 1)).cast("long"))
    sizes = chained.groupBy("file", "record").agg(size.alias("size"), F.max("first").alias("first"))
    short = chained.join(sizes.where(F.col("size") <= MAX_RECORD).select("file", "record"), ["file", "record"], "left_semi")
    texts = short.groupBy("file", "record").agg(F.array_join(F.sort_array(F.collect_list(F.struct("start", "piece", "value")))["value"], "\n").alias("value"))
    stitched = sizes.where(keep).join(texts, ["file", "record"], "left").select("value")
    ended = F.regexp_replace("value", "\r$", "")
    return whole.unionByName(stitched).select(ended.alias("value")).where("value is null or trim(value) != ''")
