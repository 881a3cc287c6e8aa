"""Quality rules with n-gram perplexity bands (operator 6).

Base rules on words, symbols, repeated lines and repeated 3-word windows come
first; then a language model of the whole corpus gives every text a
perplexity, and texts outside their language's band are rejected.

Method. A modified Kneser-Ney model of real characters (code points) in
n-grams of ``LONG`` and ``LONG - 1``. Below these it backs off to a model of
character classes: letters a-z, capital, white space, digit, punctuation,
symbol, anything else; ``ORDER`` of them in a row are one n-gram, and a class
is shared evenly by its characters. Spark counts the n-grams of all texts.
A character is scored by the counts without its own occurrence, else an
n-gram that stands once in the corpus would vouch for itself. Bands are taken
per language, around the median log perplexity of the texts that pass the base
rules: the lower and upper limits are ``SPREAD`` times the median distance of
the texts below and above it.

Scale. Tasks add up their own counts before the shuffle. The character model
grows with the corpus: it is a written table, made by joins on n-gram, context
and suffix, and never sent whole. Texts are dealt to parts of ``PART`` bytes,
about, counted from the input and compressed; each part asks for its different n-grams, the probabilities are
joined by n-gram key and come back to the part. Only the class model, at most
32 ** ORDER n-grams, is broadcast. Keys are exact where all characters lie
below U+1000, else 63 bits of a hash. Medians come from exact counts over fixed
steps of log perplexity, a bounded table per language.

Edge cases. A null or empty text has no words and fails the base rules; its
perplexity is null. A null language is a language of its own. A language whose
texts all fail gives no band and keeps nothing. Repeated rows and null ids are
kept; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import rolling as r
from quarry.llm.common import Scratch, attach, n_buckets, sent_whole, ship_package

ORDER = 4
LONG = 5      # characters of the longest n-gram; its keys are packed for five
SLICE = 1 << 20   # bytes of text taken at a time
HELD = 1 << 20    # counted n-grams a task holds before it adds them up
PART = 32 << 20   # bytes of text of a part, about
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPREAD = 8.0
STEP = 1000   # log perplexity is counted in steps of 1 / STEP
#: fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"

_WHITE, _UPPER, _DIGIT, _PUNCT, _SYMBOL, _OTHER = range(26, 32)
CLASS = np.full(256, _OTHER, dtype=np.uint8)
CLASS[97:123] = np.arange(26)
CLASS[65:91], CLASS[48:58] = _UPPER, _DIGIT
CLASS[list(b" \t\n\x0b\x0c\r")] = _WHITE
CLASS[list(b".,;:!?'\"()-")] = _PUNCT
CLASS[list(b"#*$%&|<>@^~_={}[]\\/+`")] = _SYMBOL
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(SYMBOLS)] = True


def chars(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts and the offsets of the rows among them."""
    lead = (data & 0xC0) != 0x80
    lead[off[:-1][off[:-1] < len(data)]] = True
    at = np.flatnonzero(lead)
    out = data[at].astype(np.uint64)
    size = np.diff(np.append(at, len(data)))
    wide = np.flatnonzero(size > 1)
    if len(wide):
        p, n = at[wide], np.minimum(size[wide], 4)
        v = out[wide] & (0x7F >> n).astype(np.uint64)
        for k in range(1, 4):
            m = n > k
            v[m] = v[m] << r.U64(6) | (data[p[m] + k] & 0x3F).astype(np.uint64)
        out[wide] = v
    return out, np.searchsorted(at, off)


def _before(c: np.ndarray, off: np.ndarray, n: int):
    """The character itself and those up to n - 1 places before it; texts start after white space."""
    size = np.diff(off)
    starts = [off[:-1][size > k] + k for k in range(n - 1)]
    yield c
    for k in range(1, n):
        earlier = np.empty(len(c), dtype=np.uint64)
        earlier[k:] = c[:-k]
        for at in starts[:k]:
            earlier[at] = 32
        yield earlier


def class_code(cs) -> np.ndarray:
    """Code of the class n-gram of characters (the last one first), 5 bits a class."""
    out = 0
    for k, c in enumerate(cs):
        out = out | CLASS[np.minimum(c, r.U64(128)).astype(np.int64)].astype(np.int32) << (5 * k)
    return out


#: fixed values: bits of a code point; of a character in an exact key
POINT, NARROW = 21, 12


def pack(cs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Five characters, the last one first, as (hi, lo): the last three in lo, the two before them in hi."""
    p = [r.U64(POINT), r.U64(2 * POINT)]
    return (cs[3] | cs[4] << p[0]).astype(np.int64), (cs[0] | cs[1] << p[0] | cs[2] << p[1]).astype(np.int64)


def unpack(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    low = r.U64((1 << POINT) - 1)
    hi, lo = hi.astype(np.uint64), lo.astype(np.uint64)
    return [lo & low, lo >> r.U64(POINT) & low, lo >> r.U64(2 * POINT), hi & low, hi >> r.U64(POINT)]


def keys(cs: list[np.ndarray]) -> np.ndarray:
    """Key of each n-gram: the characters themselves if all are narrow, else a hash with the top bit set."""
    out = np.zeros(len(cs[0]), dtype=np.uint64)
    top = np.zeros(len(cs[0]), dtype=np.uint64)
    for k, c in enumerate(cs):
        out |= c << r.U64(NARROW * k)
        top |= c
    wide = np.flatnonzero(top >> r.U64(NARROW))
    if len(wide):
        h = np.zeros(len(wide), dtype=np.uint64)
        for c in cs:
            h = r.mix((h ^ c[wide]) + r.U64(r.BASE))
        out[wide] = h | r.U64(1 << 63)
    return out


def _slices(col):
    """Characters of a text column in slices of rows: rows, bytes and their offsets, characters and theirs."""
    data, off = r.bytes_of(col)
    for i, j in r.slices(off, SLICE):
        d, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
        yield i, j, d, o, *chars(d, o)


def _count(batches):
    total = np.zeros(32**ORDER, dtype=np.int64)
    for batch in batches:
        hi, lo, n = (batch.column(k).to_numpy() for k in range(3))
        np.add.at(total, class_code(unpack(hi, lo)[:ORDER]), n)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])


def class_counts(long: DataFrame) -> DataFrame:
    """``(code, n)`` of the class n-grams from the counts of the character n-grams; at most 32 ** ORDER rows."""
    return long.mapInArrow(_count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def long_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(hi, lo, n)`` of the n-grams of LONG characters over all whole texts."""
    ship_package(docs.sparkSession)
    return docs.select(text_col).mapInArrow(_count_long, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def ngram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(code, n)`` over all whole texts."""
    return class_counts(long_counts(docs, text_col))


def _discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; safe where some are missing."""
    return _cuts([float((counts == k).sum()) for k in range(1, 5)])


def _cuts(n: list[float]) -> tuple[float, float, float]:
    if min(n) == 0:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(float(min(max(x, 0.05), k + 0.95)) for k, x in enumerate(d))


class KneserNey:
    """Interpolated modified Kneser-Ney model in sorted hash arrays.

    ``grams[k]``: sorted hashes of the (k + 1)-grams and what their own counts
    give; ``contexts[k]``: sorted hashes of the k-grams and the weight left to
    the next lower order."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.grams, self.contexts = [], []
        code = code.astype(np.int64)
        for k in range(ORDER, 0, -1):
            low = code & (32**k - 1)
            if k == ORDER:
                keys, counts = low, n.astype(np.float64)
            else:  # continuation counts: different (k + 1)-grams that end so
                keys, counts = np.unique(np.unique(code & (32 ** (k + 1) - 1)) & (32**k - 1), return_counts=True)
                counts = counts.astype(np.float64)
            d = np.array([0.0, *_discounts(counts)])
            cut = d[np.minimum(counts, 3).astype(int)]
            context = keys >> 5
            total = np.zeros(32 ** (k - 1))
            left = np.zeros(32 ** (k - 1))
            np.add.at(total, context, counts)
            np.add.at(left, context, cut)
            seen = np.flatnonzero(total)
            self.grams.insert(0, self._sorted(keys, (counts - cut) / total[context]))
            self.contexts.insert(0, self._sorted(seen, left[seen] / total[seen]))

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        return r.mix(keys.astype(np.uint64) + r.U64(1))

    def _sorted(self, keys, values):
        h = self._hash(keys)
        order = np.argsort(h)
        return h[order], values[order].astype(np.float64)

    def _find(self, pair, keys, missing):
        h, values = pair
        if not len(h):
            return np.full(len(keys), missing)
        want = self._hash(keys)
        at = np.minimum(np.searchsorted(h, want), len(h) - 1)
        return np.where(h[at] == want, values[at], missing)

    def log_table(self) -> np.ndarray:
        """Natural log probability of the last class of every possible n-gram."""
        p = np.full(1, 1 / 32)
        for k in range(1, ORDER + 1):
            keys = np.arange(32**k)
            own = self._find(self.grams[k - 1], keys, 0.0)
            back = self._find(self.contexts[k - 1], keys >> 5, 1.0)
            p = own + back * p[keys & (32 ** (k - 1) - 1)]
        return np.log(np.maximum(p, 1e-12))


def _different(k):
    """Different keys in order of their first place, the number of each key among them, and their counts: a hash table,
    as a slice of text has ten times as many n-grams as different ones."""
    at, found = pd.factorize(k)
    return found, at, np.bincount(at, minlength=len(found))


def _added(held):
    """Sorted keys of several counted slices, and the sums of their counts."""
    k, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[at], np.add.reduceat(n, at)


def _counted(hi, lo, n):
    return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(n.astype(np.int64))], names=["hi", "lo", "n"])


def _count_long(batches):
    def give(held):
        u, n = _added(held)
        held.clear()
        return _counted(*pack([u >> r.U64(NARROW * x) & r.U64((1 << NARROW) - 1) for x in range(LONG)]), n)

    held, size = [], 0
    for batch in batches:
        for _i, _j, _d, _o, c, off in _slices(batch.column(0)):
            cs = list(_before(c, off, LONG))
            k = keys(cs)
            wide = np.flatnonzero(k >> r.U64(63))
            if len(wide):
                _, at, n = np.unique(k[wide], return_index=True, return_counts=True)
                yield _counted(*pack([x[wide[at]] for x in cs]), n)
                k = np.delete(k, wide)
            if len(k):
                held.append(_different(k)[::2])
                size += len(held[-1][0])
            if size >= HELD:
                yield give(held)
                size = 0
    if held:
        yield give(held)


def _base(shared, others):
    """Probability of the last character of each n-gram by the class model."""
    members = np.bincount(CLASS[:128], minlength=32).astype(np.float64)
    members[_OTHER] += others

    def run(batches):
        p = np.exp(shared.value.log_table()) / members[np.arange(32**ORDER) & 31]
        for batch in batches:
            hi, lo = (batch.column(k).to_numpy() for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p[class_code(unpack(hi, lo)[:ORDER])])], names=["hi", "lo", "n", "base"])

    return run


def _keyed(batches):
    for batch in batches:
        k = keys(unpack(*(batch.column(x).to_numpy() for x in (0, 1))))
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), batch.column(2)], names=["key", "log_p"])


def _weights(grams: DataFrame):
    """Column function: the discount of a count, from the counts of counts of a table."""
    found = {x["n"]: float(x["k"]) for x in grams.where("n < 5").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    d = _cuts([found.get(k, 0.0) for k in range(1, 5)])
    return lambda n: F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _own(cut, low, less: bool):
    """Interpolated probability from n, total and left; ``less``: as if the n-gram stood once less."""
    n, total, left = F.col("n"), F.col("total"), F.col("left")
    if not less:
        return (n - cut(n) + left * low) / total
    # the last occurrence gone, nothing is known but the lower order
    return F.when(total == 1, low).otherwise((n - 1 - cut(n - 1) + (left - cut(n) + cut(n - 1)) * low) / F.greatest(total - 1, F.lit(1)))


def ngram_model(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Written table ``(key, log_p)`` with one row per different n-gram of LONG characters: natural log probability of
    its last character, by the counts of all texts without this occurrence."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    long = scratch.write(long_counts(docs, text_col), "quality-long")
    counts = class_counts(long).toPandas().sort_values("code")  # bounded: 32 ** ORDER rows
    shared = spark.sparkContext.broadcast(KneserNey(counts["code"].to_numpy(), counts["n"].to_numpy()))
    point = (1 << POINT) - 1
    # all but the last character: the others move up
    x_lo = F.shiftright("lo", POINT).bitwiseOR(F.shiftleft(F.col("hi").bitwiseAND(F.lit(point)), 2 * POINT)).alias("x_lo")
    x_hi = F.shiftright("hi", POINT).alias("x_hi")
    s_hi = F.col("hi").bitwiseAND(F.lit(point))
    # counts of the shorter n-grams: the different characters they follow
    short = scratch.write(long.groupBy(s_hi.alias("hi"), "lo").agg(F.count(F.lit(1)).alias("n")), "quality-short")
    others = short.select(F.col("lo").bitwiseAND(F.lit(point)).alias("c")).where("c >= 128").distinct().count()

    def contexts(grams, cut, *x):
        return grams.groupBy(*x).agg(F.sum("n").alias("total"), F.sum(cut(F.col("n"))).alias("left"))

    cut = _weights(short)
    lower = attach(short.mapInArrow(_base(shared, others), "hi long, lo long, n long, base double").withColumn("x_lo", x_lo),
                   contexts(short, cut, x_lo), ["x_lo"], "inner")
    lower = lower.select(F.col("hi").alias("s_hi"), "lo", _own(cut, F.col("base"), False).alias("p"), _own(cut, F.col("base"), True).alias("q"))
    cut = _weights(long)
    upper = attach(long.withColumns({"x_hi": x_hi, "x_lo": x_lo, "s_hi": s_hi}), contexts(long, cut, x_hi, x_lo), ["x_hi", "x_lo"], "inner")
    # where the only occurrence goes, the shorter n-gram follows one character less
    low = F.when(F.col("n") == 1, F.col("q")).otherwise(F.col("p"))
    upper = attach(upper, lower, ["s_hi", "lo"], "inner").select("hi", "lo", F.log(F.greatest(_own(cut, low, True), F.lit(1e-12))).alias("log_p"))
    out = scratch.write(upper.mapInArrow(_keyed, "key long, log_p double"), "quality-model")
    scratch.drop(long, short)
    return out


def _deal(batches):
    """Rows of each part, compressed."""
    for batch in batches:
        part = batch.column(0).to_numpy()
        order = np.argsort(part, kind="stable")
        found, lo = np.unique(part[order], return_index=True)
        rows = batch.select(["_id", "_lang", "_text"])
        for k, s, e in zip(found.tolist(), lo, np.append(lo[1:], len(order)), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows.take(pa.array(order[s:e])))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["part", "body"])


def _dealt(table):
    for chunk in table.column("body").chunks:
        for x in chunk:
            with pa.ipc.open_stream(x.as_buffer()) as rows:
                yield from rows


def _asked(table):
    """The different n-grams of a part. Sorted runs are merged in levels, each with one of its own size at most."""
    runs = []
    for rows in _dealt(table):
        for _i, _j, _d, _o, c, off in _slices(rows.column(2)):
            runs.append(np.sort(pd.unique(keys(list(_before(c, off, LONG))))))
            while len(runs) > 1 and len(runs[-2]) < 2 * len(runs[-1]):
                runs.append(np.union1d(runs.pop(), runs.pop()))
    while len(runs) > 1:
        runs.append(np.union1d(runs.pop(), runs.pop()))
    found = runs[0] if runs else np.zeros(0, dtype=np.uint64)
    part = table.column("part")[0].as_py()
    return pa.table([pa.array(np.full(len(found), part, dtype=np.int32)), pa.array(found.view(np.int64))], names=["part", "key"])


_SCORED = pa.schema([("_id", pa.int64()), ("_lang", pa.string()), *((c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("log_ppl", pa.float64())])
_SCORED_DDL = ("_id long, _lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, log_ppl double")


def _dup_lines(raw: bytes) -> int:
    lines = raw.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[bytes] = set()
    n = 0
    for x in lines:
        if x in seen and x.split(None, 1):
            n += 1
        seen.add(x)
    return n


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(values)])
    return c[off[1:]] - c[off[:-1]]


def repeat_words(w: r.Words, rows: int) -> np.ndarray:
    """Words in 3-word windows that stand twice or more in their text."""
    g, ok = w.grams(3)
    if not len(g):
        return np.zeros(rows, dtype=np.int64)
    at = np.flatnonzero(ok)
    row, g = w.row[at], g[at]
    order = np.lexsort((g, row))
    a, b = row[order], g[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    hit = at[order[again]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 3, -1)
    return np.bincount(w.row[np.cumsum(cover[:-1]) > 0], minlength=rows)


def _score(table, answers):
    """Base figures and log perplexity of the texts of a part."""
    known = answers.column("key").to_numpy().view(np.uint64)
    order = np.argsort(known)
    known, log_p = known[order], answers.column("log_p").to_numpy()[order]
    out = []
    for rows in _dealt(table):
        base = np.zeros((len(rows), 5), dtype=np.int64)
        ppl = np.full(len(rows), np.nan)
        for i, j, d, o, c, off in _slices(rows.column(2)):
            w = r.Words(d, o)
            base[i:j, 0] = w.count
            base[i:j, 1] = _per_row(((d & 0xC0) != 0x80) & ~r.WHITE_BYTE[d], o)
            base[i:j, 2] = _per_row(IS_SYMBOL[d], o)
            base[i:j, 3] = [_dup_lines(d[a:b].tobytes()) for a, b in zip(o[:-1], o[1:], strict=True)]
            base[i:j, 4] = repeat_words(w, j - i)
            size = np.diff(off)
            if not len(c):
                continue
            k, of, _ = _different(keys(list(_before(c, off, LONG))))
            at = np.minimum(np.searchsorted(known, k), len(known) - 1) if len(known) else np.zeros(0, dtype=np.int64)
            if len(at) != len(k) or (known[at] != k).any():
                raise ValueError("an n-gram of a text isn't in the model: the input changed between two reads")
            sums = np.bincount(np.repeat(np.arange(j - i), size), weights=log_p[at][of], minlength=j - i)
            ppl[i:j] = np.where(size > 0, -sums / np.maximum(size, 1), np.nan)
        out.append(pa.RecordBatch.from_arrays([rows.column(0), rows.column(1).cast(pa.string()), *(pa.array(base[:, k]) for k in range(5)),
                                               pa.array(ppl, mask=np.isnan(ppl))], schema=_SCORED))
    return pa.Table.from_batches(out, schema=_SCORED)


def with_log_ppl(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``_id``, ``_lang``, the base figures and ``log_ppl`` of every row."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    parts = max(n_buckets(docs.sparkSession, 0.5), -(-size // PART))
    part = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)), F.lit(parts)).cast("int").alias("part")
    texts = docs.select(part, F.col(id_col).cast("long").alias("_id"), F.col(lang_col).cast("string").alias("_lang"),
                        F.col(text_col).alias("_text")).mapInArrow(_deal, "part int, body binary")
    # both uses of texts read one exchange
    asked = texts.groupBy("part").applyInArrow(_asked, "part int, key long")
    answers = attach(asked, model, ["key"], "inner").select("part", "key", "log_p")
    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_score, _SCORED_DDL)


def _median(table: DataFrame, value: str, name: str) -> DataFrame:
    """Median step of each language, from exact counts over steps."""
    c = table.groupBy("_lang", F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    order = Window.partitionBy("_lang").orderBy("v")
    c = c.withColumn("upto", F.sum("k").over(order)).withColumn("all", F.sum("k").over(Window.partitionBy("_lang")))
    return c.where(2 * F.col("upto") >= F.col("all")).groupBy("_lang").agg(F.min("v").alias(name))


def bands(scored: DataFrame, spread: float = SPREAD) -> DataFrame:
    """``(_lang, low, high)`` from the texts that pass the base rules."""
    passed = scored.where("NOT base_failed AND log_ppl IS NOT NULL").select(
        F.coalesce("_lang", F.lit("\0")).alias("_lang"), F.round(F.col("log_ppl") * STEP).cast("long").alias("v"))
    scratch = Scratch(scored.sparkSession)
    middle = scratch.write(_median(passed, "v", "mid"), "quality-middle")  # a row a language
    off = passed.join(sent_whole(middle, F.octet_length("_lang")), "_lang").withColumn("d", F.abs(F.col("v") - F.col("mid")))
    below = _median(off.where("v <= mid"), "d", "below")
    above = _median(off.where("v >= mid"), "d", "above")
    # a language of a few equal texts still gets a band of 0.1
    width = [F.greatest(F.coalesce(c, F.lit(0)) * spread, F.lit(STEP / 10)) for c in ("below", "above")]
    return (middle.join(below, "_lang", "left").join(above, "_lang", "left")
            .select("_lang", ((F.col("mid") - width[0]) / STEP).alias("low"), ((F.col("mid") + width[1]) / STEP).alias("high")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  spread: float = SPREAD) -> DataFrame:
    """One row per input row: ``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    perplexity, kept)``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    model = ngram_model(docs, text_col)
    scored = Scratch(docs.sparkSession).write(
        with_log_ppl(docs, model, id_col, text_col, lang_col).withColumn("base_failed", failed), "quality-scored")
    limits = Scratch(docs.sparkSession).write(bands(scored, spread).withColumnRenamed("_lang", "_key"), "quality-bands")
    limits = sent_whole(limits, F.octet_length("_key"))  # few languages, of any size: the texts stay where they are
    ok = F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False))
    return scored.join(limits, F.coalesce("_lang", F.lit("\0")) == F.col("_key"), "left").select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.exp("log_ppl").alias("perplexity"), (~F.col("base_failed") & ok).alias("kept"))
