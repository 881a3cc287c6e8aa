"""K-means passes over packed vectors, with distance bounds per entity.

For centroid tables that fit a counted bound (clusters x features). Entities
are packed once into blocks: sparse rows as flat arrays, with each entity's
cluster and two bounds beside them. A bound says how far the entity is from its
own centroid at most, and from every other one at least. When centroids move,
the triangle inequality moves the bounds; entities whose bounds no longer
decide are measured again.

A full pass brings clusters and bounds of all entities up to date, writes the
blocks below the shared folder and adds the sums up anew, so that neither
lineage nor rounding grows with the number of passes. For the passes after it,
a reach is set that centroids may move in all. Entities whose bounds decide
whatever happens within that reach stay out; only the open ones are dealt over
the cores and kept there. Such a pass sends the centroids out, measures the open
entities and brings back sums, sizes and a mark of their assignment. It moves
no vectors between tasks, writes nothing and plans no query. After ``CUT``
passes, or when a centroid leaves the reach, a full pass follows.

No entity has moved when the marks of two passes over the same open entities
are equal: the passes end.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import BROADCAST_ROWS, bounded_side, drop_written, ship_package, written_table

CUT = 50               # passes between full passes, at most
BLOCK_VALUES = 1 << 18 # values of a block
PART_VALUES = 1 << 23  # values of a part of the open entities, where there are more parts than cores
CELLS = 1 << 21        # products held at a time
DIGITS = 9             # decimals that distances are compared at
MARGIN = 1e-7          # bounds closer than this (squared, relative) decide nothing


class NotStable(RuntimeError):
    """K-means was stopped while entities still moved."""


# ------------------------------------------------------------------ blocks

_FIELDS = ("nx", "at", "val", "off", "cluster", "upper", "lower")
_KINDS = dict(zip(_FIELDS, ("<f8", "<i4", "<f8", "<i8", "<i4", "<f8", "<f8")))


def _pack(entity_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("at")
            off = lists.offsets.to_numpy().astype(np.int64)
            at, val = lists.flatten().to_numpy(zero_copy_only=False), b.column("val").flatten().to_numpy(zero_copy_only=False)
            off = off - off[0]
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(off, off[i] + BLOCK_VALUES, side="right")) - 1)
                n, s = j - i, slice(off[i], off[j])
                cols = (b.column("nx").to_numpy(zero_copy_only=False)[i:j], at[s], val[s], off[i: j + 1] - off[i], np.full(n, -1), np.zeros(n), np.zeros(n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("entity").slice(i, n).to_pylist()], pa.list_(entity_type)),
                     *(pa.array([np.ascontiguousarray(c, dtype=_KINDS[f]).tobytes()], pa.binary()) for f, c in zip(_FIELDS, cols)),
                     pa.array([None], pa.list_(pa.int64())), pa.array([None], pa.list_(pa.float64()))],
                    ["entity", *_FIELDS, "keys", "sums"])
                i = j
    return run


def _read(b: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    return _matrix({f: np.frombuffer(b.column(f)[i].as_py(), dtype=k) for f, k in _KINDS.items()})


def _matrix(block: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The block with its vectors as a matrix ``x``, where each of them holds the same first features once."""
    n, at = len(block["nx"]), block["at"]
    width = int(at[-1]) + 1 if len(at) else 0
    if width and len(at) == n * width and (at.reshape(n, width) == np.arange(width)).all():
        return block | {"x": block["val"].reshape(n, width)}
    return block


def _values(off: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of all values of some rows, row by row."""
    size = off[rows + 1] - off[rows]
    return np.repeat(off[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())


class Centres:
    """Centroids as sums over members, sizes, and the squared norm of the sums."""

    def __init__(self, sums: np.ndarray, sizes: np.ndarray):
        self.sums, self.sizes = sums, sizes.astype(float)
        self.squares = (sums * sums).sum(axis=0)

    def nearest(self, block: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``(cluster, distance)`` of all of a block's entities, ties to the smaller cluster."""
        rows = np.arange(len(block["nx"]))
        d = np.round(self.distances(block, rows), DIGITS)
        cluster = np.argmin(d, axis=1)
        return cluster.astype(np.int32), d[rows, cluster]

    def distances(self, block: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
        """Squared distance of some of a block's entities to every centroid."""
        k = self.sums.shape[1]
        if "x" in block:
            x = block["x"] if len(rows) == len(block["x"]) else block["x"][rows]
            dots = x @ self.sums[: x.shape[1]]
            return block["nx"][rows, None] - 2.0 * dots / self.sizes + self.squares / (self.sizes * self.sizes)
        dots = np.zeros((len(rows), k))
        size = block["off"][rows + 1] - block["off"][rows]
        edge = np.concatenate([[0], np.cumsum(size)])
        i = 0
        while i < len(rows):
            j = max(i + 1, int(np.searchsorted(edge, edge[i] + CELLS // k, side="right")) - 1)
            at = _values(block["off"], rows[i:j])
            some = np.flatnonzero(size[i:j])
            if len(some):
                part = self.sums[block["at"][at]] * block["val"][at, None]
                dots[i + some] = np.add.reduceat(part, (edge[i:j] - edge[i])[some], axis=0)
            i = j
        return block["nx"][rows, None] - 2.0 * dots / self.sizes + self.squares / (self.sizes * self.sizes)


def _decided(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Whether bounds leave no entity of another cluster nearer."""
    return (lower > 0) & (lower * lower - upper * upper > MARGIN * (1 + upper * upper))


def _assign(centres: Centres, shift: np.ndarray | None, whole: bool, reach: float = 0.0):
    """One pass over blocks. ``shift``: how far each centroid has moved, None for the first pass.
    ``whole``: sums over all entities, not only the moved ones. ``reach``: how far centroids may
    move after this pass; entities that it may leave open are measured too."""
    n_features, k = centres.sums.shape
    stats = n_features * k
    if shift is not None:
        top = np.argsort(shift)[::-1]
        other = np.full(k, shift[top[0]])
        other[top[0]] = shift[top[1]] if k > 1 else 0.0

    def one(block: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        old = block["cluster"]
        cluster, n = old.copy(), len(old)
        if shift is None:
            upper, lower, active = np.zeros(n), np.zeros(n), np.arange(n)
        else:
            upper, lower = block["upper"] + shift[old], block["lower"] - other[old]
            active = np.flatnonzero(~_decided(upper + reach, lower - reach))
        if len(active):
            d = centres.distances(block, active)
            best = np.argmin(np.round(d, DIGITS), axis=1)  # ties to the smaller cluster
            mine = np.arange(len(active))
            upper[active] = np.sqrt(np.maximum(d[mine, best], 0))
            d[mine, best] = np.inf
            lower[active] = np.sqrt(np.maximum(d.min(axis=1), 0))
            cluster[active] = best
        moved = np.flatnonzero(cluster != old)
        keys, adds = [stats + k * np.ones(1, dtype=np.int64)], [np.array([len(moved)], dtype=float)]
        for rows, of, sign in ((np.arange(n) if whole else moved, cluster, 1.0), (moved if not whole else moved[:0], old, -1.0)):
            at = _values(block["off"], rows)
            keys += [np.repeat(of[rows], block["off"][rows + 1] - block["off"][rows]) + k * block["at"][at].astype(np.int64), stats + of[rows]]
            adds += [sign * block["val"][at], np.full(len(rows), sign)]
        keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        return block | {"cluster": cluster, "upper": upper, "lower": lower, "keys": keys, "sums": np.bincount(place, np.concatenate(adds), len(keys))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                new = one(_read(b, i))
                yield pa.RecordBatch.from_arrays(
                    [b.column("entity").slice(i, 1), *(pa.array([np.ascontiguousarray(new[f], dtype=t).tobytes()], pa.binary()) for f, t in _KINDS.items()),
                     *(pa.array([new[f]], pa.list_(pa.from_numpy_dtype(new[f].dtype))) for f in ("keys", "sums"))], ["entity", *_FIELDS, "keys", "sums"])
    return run


_OPEN = ("nx", "at", "val", "off")


def _open(reach: float):
    """Blocks of the entities whose cluster may change while no centroid moves further than ``reach``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = {f: np.frombuffer(b.column(f)[i].as_py(), dtype=k) for f, k in _KINDS.items() if f in b.schema.names}
                rows = np.flatnonzero(~_decided(block["upper"] + reach, block["lower"] - reach))
                if len(rows):
                    at = _values(block["off"], rows)
                    cols = (block["nx"][rows], block["at"][at], block["val"][at], np.concatenate([[0], np.cumsum(np.diff(block["off"])[rows])]))
                    yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c, dtype=_KINDS[f]).tobytes()], pa.binary()) for f, c in zip(_OPEN, cols)], list(_OPEN))
    return run


def _add_members(block: dict[str, np.ndarray], cluster: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> None:
    """Adds a block's vectors to the sums and sizes of their clusters."""
    k = len(sizes)
    members = np.bincount(cluster, minlength=k)
    sizes += members
    if "x" in block:
        held, order = np.flatnonzero(members), np.argsort(cluster, kind="stable")
        sums[: block["x"].shape[1], held] += np.add.reduceat(block["x"][order], (np.cumsum(members) - members)[held], axis=0).T
    else:
        np.add.at(sums.reshape(-1), np.repeat(cluster, np.diff(block["off"])) + k * block["at"].astype(np.int64), block["val"])


def _measure(centres: Centres, before: Centres | None = None):
    """One pass over a part of the open entities: ``(sums, sizes, mark, moved)``. ``moved`` is counted from the centroids ``before``."""
    def run(blocks: Iterator[dict[str, np.ndarray]]) -> Iterator[tuple]:
        sums, sizes, mark, moved = np.zeros(centres.sums.shape), np.zeros(len(centres.sizes)), 0, 0
        for block in blocks:
            cluster, _ = centres.nearest(block)
            _add_members(block, cluster, sums, sizes)
            mark += int.from_bytes(hashlib.blake2b(block["nx"].tobytes() + cluster.tobytes(), digest_size=16).digest())
            if before is not None:
                moved += int((cluster != before.nearest(block)[0]).sum())
        yield sums, sizes, mark, moved
    return run


def _add(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def _result(centres: Centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                cluster, dist = centres.nearest(_read(b, i))
                yield pa.RecordBatch.from_arrays([b.column("entity").slice(i, 1).flatten(), pa.array(cluster), pa.array(dist)], ["entity", "cluster", "dist"])
    return run


# ------------------------------------------------------------------ passes


def packed(inc: DataFrame, nx: DataFrame, index: DataFrame, n_features: int, value: str | None) -> DataFrame:
    """Blocks of all entities of ``nx``, as a written table."""
    v = F.col(value).cast("double") if value else F.lit(1.0)
    vectors = (inc.join(bounded_side(index, n_features), "feature").groupBy("entity")
               .agg(F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("at"), v.alias("val")))).alias("v")))
    none = F.array().cast("array<struct<at: int, val: double>>")
    vectors = nx.join(vectors, "entity", "left").withColumn("v", F.coalesce("v", none))
    kind = inc.schema["entity"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    blocks = vectors.select("entity", F.col("nx").cast("double").alias("nx"), F.col("v.at").alias("at"), F.col("v.val").alias("val")).mapInArrow(
        _pack(to_arrow_type(kind)), _schema(kind.simpleString()))
    return written_table(blocks, "kmeans-blocks")


def _schema(kind: str) -> str:
    return f"entity array<{kind}>, " + ", ".join(f"{f} binary" for f in _FIELDS) + ", keys array<long>, sums array<double>"


def _dealt(blocks: DataFrame, reach: float, parts: int) -> RDD:
    """The open entities in even parts, kept by the executors; where memory ends, on their disks."""
    rows = blocks.select(*_OPEN, "upper", "lower").mapInArrow(_open(reach), ", ".join(f"{f} binary" for f in _OPEN)).repartition(parts).rdd
    return rows.map(lambda r: _matrix({f: np.frombuffer(r[f], dtype=_KINDS[f]) for f in _OPEN})).persist(StorageLevel.MEMORY_AND_DISK)


def _moved_by(old: Centres, new: Centres) -> np.ndarray:
    return np.sqrt(((new.sums / new.sizes - old.sums / old.sizes) ** 2).sum(axis=0))


def passes(inc: DataFrame, nx: DataFrame, start_counts: DataFrame, index: DataFrame, n_features: int, n_entities: int, k: int,
           max_iter: int | None, value: str | None) -> tuple[DataFrame, int, int]:
    """``(assignment, passes, moved)`` from the start centroids ``(cluster, feature, cnt)``; see ``cluster.kmeans``."""
    spark = inc.sparkSession
    ship_package(spark)
    kind = inc.schema["entity"].dataType.simpleString()
    sums = np.zeros((n_features, k))
    for r in start_counts.join(bounded_side(index, n_features), "feature").select("cluster", "idx", "cnt").collect():  # clusters x features at most
        sums[r["idx"], r["cluster"]] += r["cnt"]
    centres = Centres(sums, np.ones(k))
    blocks = packed(inc, nx, index, n_features, value)
    held = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum(F.octet_length("val")), F.lit(0)).alias("bytes")).first()
    parts = max(1, min(held["blocks"], max(spark.sparkContext.defaultParallelism, held["bytes"] // (8 * PART_VALUES))))

    def full_pass(shift: np.ndarray | None, reach: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Brings the blocks up to the centroids; ``(sums, sizes, moved)`` over all entities."""
        nonlocal blocks
        old, blocks = blocks, written_table(blocks.mapInArrow(_assign(centres, shift, True, reach), _schema(kind)), "kmeans-blocks")
        drop_written(old)
        found = blocks.select(F.explode(F.arrays_zip("keys", "sums")).alias("c")).groupBy("c.keys").agg(F.sum("c.sums").alias("sum")).toPandas()
        change = np.zeros(n_features * k + k + 1)
        change[found["keys"].to_numpy(dtype=np.int64)] = found["sum"].to_numpy(dtype=float)
        return change[: n_features * k].reshape(n_features, k), change[n_features * k: -1], int(change[-1])

    def open_pass(before: Centres | None = None) -> tuple[np.ndarray, np.ndarray, int, int]:
        found = vectors.mapPartitions(_measure(centres, before))
        if parts * n_features * k > BROADCAST_ROWS:  # numbers that would reach the driver at once
            return found.treeReduce(_add)
        return functools.reduce(_add, found.collect())

    total, sizes, moved = full_pass(None, 0.0)
    base, vectors, reach, seen, done, since = centres, None, 0.0, set(), 0, 0
    while moved and (max_iter is None or done < max_iter):
        kept = sizes > 0  # an emptied cluster keeps its centroid
        new = Centres(np.where(kept, total, centres.sums), np.where(kept, sizes, centres.sizes))
        state = hashlib.blake2b(np.round(new.sums, DIGITS).tobytes() + new.sizes.tobytes()).digest()
        if state in seen:
            raise NotStable(f"entities still move after {done} passes, and the state has come up before")
        seen.add(state)
        if vectors is None or since >= CUT or not _moved_by(base, new).max() <= reach:
            reach = _moved_by(centres, new).max() * max(1.0, CUT / 2)
            if vectors is not None:
                vectors.unpersist()
                total, sizes, _ = full_pass(_moved_by(base, centres), reach)
            vectors, base, since = _dealt(blocks, reach, parts), centres, 0
            open_sums, open_sizes, mark, _ = open_pass()
            fixed_sums, fixed_sizes = total - open_sums, sizes - open_sizes
        before, centres, done, since = centres, new, done + 1, since + 1
        open_sums, open_sizes, now, moved = open_pass(before if done == max_iter else None)
        total, sizes = fixed_sums + open_sums, fixed_sizes + open_sizes
        if done != max_iter:
            moved = now != mark
        mark = now
    out = written_table(blocks.mapInArrow(_result(centres), f"entity {kind}, cluster int, dist double"), "kmeans-assigned")
    if vectors is not None:
        vectors.unpersist()
    drop_written(blocks)
    return out, done, int(moved)
