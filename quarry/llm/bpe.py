"""Byte-level BPE encoding and decoding (operator 10).

Each match of a split pattern (a pre-token) is encoded on its own: its bytes
merge pairwise, the pair with the lowest rank first, the leftmost of equals.

Method. Two tiers. A minimal perfect hash over the vocabulary resolves, in one
vectorised probe, pre-tokens that are a token as a whole (the stored bytes are
compared). The rest merge over a linked list of bytes with a heap of
candidate pairs: O(n log n) for a pre-token of n bytes, however long.

Scale. A map over rows without a shuffle. The vocabulary is read by the driver
and broadcast (its size is the file's). Texts are cut into groups of about a
megabyte; a bounded cache keeps the ids of recent pre-tokens.

Edge cases. A null or empty text has no tokens. Texts of any length are encoded
whole. Repeated rows and null ids are kept as they are; other columns are
ignored. A vocabulary without all 256 bytes, or with unusual ranks, is refused.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ship_package
from quarry.llm.rolling import mix, pieces

GROUP = 1 << 20           # bytes of text encoded at a time
CACHE = 150_000           # pre-tokens whose ids a task keeps
TRIES = 64                # displacements tried at a time
U64 = np.uint64


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if len(set(tokens)) != len(tokens) or not {bytes([i]) for i in range(256)} <= set(tokens):
        raise ValueError("ranks must be 0..n-1, tokens distinct, and every single byte a token")
    return tokens


class PerfectHash:
    """Minimal perfect hash: keys fall into small buckets, each with a
    displacement that sends its keys to free slots; buckets of one key name
    their slot outright. Slots hold the key's rank."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 3)
        h = self.hashes(keys)
        if len(np.unique(h)) != n:
            raise ValueError("two tokens share a 64-bit hash")
        self.move = np.zeros(self.buckets, dtype=np.int64)
        self.rank = np.zeros(n, dtype=np.int64)
        bucket = self._scale(h, self.buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        taken = np.zeros(n, dtype=bool)
        sizes = np.diff(edges)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[edges[b]: edges[b + 1]]
            if len(own) < 2:
                break
            d, found = 0, False
            while not found:  # TRIES displacements at a time
                move = np.arange(d, d + TRIES, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
                slots = self._scale(mix(h[own][None, :] ^ move[:, None]), n)
                ok = ~taken[slots].any(axis=1)
                for k in np.flatnonzero(ok):
                    if len(set(slots[k].tolist())) == len(own):
                        self.move[b], taken[slots[k]], self.rank[slots[k]] = d + int(k), True, own
                        found = True
                        break
                d += TRIES
        free = np.flatnonzero(~taken)
        ones = np.flatnonzero(sizes == 1)
        self.move[ones] = -1 - free
        self.rank[free] = order[edges[ones]]

    @staticmethod
    def hashes(keys) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))

    @staticmethod
    def _scale(h: np.ndarray, n: int) -> np.ndarray:
        return (((h >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """The only rank that each key can have; the caller compares the bytes."""
        h = self.hashes(keys)
        d = self.move[self._scale(h, self.buckets)]
        moved = self._scale(mix(h ^ (np.maximum(d, 0).astype(np.uint64) * U64(0x9E3779B97F4A7C15))), self.n)
        return self.rank[np.where(d < 0, -1 - d, moved)]


def merge(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: lowest-ranked pair first, over linked bytes."""
    n = len(piece)
    after = list(range(1, n + 1))       # start of the next part; n ends the list
    before = list(range(-1, n - 1))
    alive = bytearray(b"\1") * n
    get = rank_of.get
    heap = [(k, i, i + 2) for i in range(n - 1) if (k := get(piece[i: i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        if not alive[i]:
            continue
        j = after[i]
        if j >= end or after[j] != end:
            continue  # one of the two parts has changed
        alive[j] = 0
        after[i] = end
        if end < n:
            before[end] = i
            stop = after[end]
            if (k := get(piece[i:stop])) is not None:
                heappush(heap, (k, i, stop))
        p = before[i]
        if p >= 0 and (k := get(piece[p:end])) is not None:
            heappush(heap, (k, p, end))
    out, i = [], 0
    while i < n:
        out.append(rank_of[piece[i: after[i]]])
        i = after[i]
    return out


class Encoder:
    """Text to packed ids, little-endian unsigned 32-bit."""

    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str):
        self.tokens, self.table = tokens, table
        self.rank_of = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        for piece, b, k in zip(pieces, raw, self.table.probe(raw).tolist(), strict=True):
            if self.tokens[k] == b:
                self.cache[piece] = k.to_bytes(4, "little")
            else:
                self.cache[piece] = np.array(merge(b, self.rank_of), dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list(set().union(*pieces).difference(self.cache))
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


def _encoder(shared, pattern):
    schema = pa.schema([("_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_binary())])

    def run(batches):
        enc = Encoder(*shared.value, pattern)
        for batch in (p for whole in batches for p in pieces(whole, 1, GROUP)):
            out = enc.encode([t.as_py() or "" for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in out], pa.int64()),
                                              pa.array(out, pa.large_binary())], schema=schema)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id_col, n_tokens, ids)``; ``ids`` packs the ids as little-endian unsigned 32-bit integers."""
    ship_package(docs.sparkSession)
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))
    out = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _encoder(shared, pattern), "_id long, n_tokens long, ids binary")
    return out.withColumnRenamed("_id", id_col)


def decode(ids: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the bytes that packed ids stand for; null ids give no bytes."""
    ship_package(ids.sparkSession)
    shared = ids.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    fields = ids.schema
    at = ids.columns.index(ids_col)

    def run(batches):
        get = shared.value.__getitem__
        for batch in (p for whole in batches for p in pieces(whole, at)):
            got = [b"".join(map(get, np.frombuffer(x.as_buffer() if x.is_valid else b"", dtype="<u4").tolist())) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.large_binary())], names=[*batch.schema.names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out_col}` binary"
    return ids.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoding and decoding in one pass, with one Python worker a task: ``(id_col, n_tokens, ids, decoded)``."""
    ship_package(docs.sparkSession)
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))
    encoded = _encoder(shared, pattern)

    def run(batches):
        get = shared.value[0].__getitem__
        for batch in encoded(batches):
            got = [b"".join(map(get, np.frombuffer(x.as_buffer(), dtype="<u4").tolist())) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.large_binary())], names=[*batch.schema.names, "decoded"])

    out = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, "_id long, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("_id", id_col)
