"""License scan by an exact set-similarity join with templates (operator 12).

Words are runs of ASCII letters and digits and of any other characters beyond
ASCII, A-Z lower-cased. Base: places where the words of a stated phrase stand
consecutively. On top of them, labels of license templates that a text block
contains: a template is the set of its words, a block the set of
``2 * scale`` words that start at a multiple of ``scale``, where ``scale`` is the
smallest of 16, 64, 256, ... that is no less than the template's words (a
template that stands in a text in one piece is then inside some block). A pair
is found when the block holds ``percent`` of 100 of the template's words.

Method. An exact set-similarity join: words are ordered by their count in all
documents, the rarest first. Template and block of a found pair share a word
within their prefixes (all but ``need - 1`` words), so blocks meet templates on
single prefix words, the rarest there are. The length filter drops blocks with
too few template words, the positional filter pairs whose remaining words can't
make up the overlap; the overlap of what is left is counted. No pair over the
threshold is lost. Words outside every template can't add to an overlap and
are left out of the sets.

Scale. Two passes over the texts: one counts the templates' words, one scans
texts and keeps the blocks that hold a prefix word. The join's template side is
bounded by the caller's list, counted, and broadcast under a bound; blocks are
bounded by their scale, so a very long text is only more blocks.

Edge cases. Null and empty texts have no words and no labels; rows that repeat
are scanned each on its own; empty tables give empty results; templates without
words never match; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, attach, sent_whole, ship_package

#: of lower-cased UTF-8: neither a control nor an ASCII sign
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LEAST_SCALE = 16
PERCENT = 90

#: fixed values: the phrases of the base rule and their labels
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: fixed values: notices by which public licenses are given, and their labels
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())  # of bytes, so only A-Z change


def scale_of(n_words: int) -> int:
    s = LEAST_SCALE
    while s < n_words:
        s *= 4
    return s


def needed(size: int, percent: int) -> int:
    """Words that a block must share with a template of ``size`` different ones."""
    return max(1, -(-size * percent // 100))


# ------------------------------------------------------------------ passes over the texts


def _texts(col: pa.Array) -> Iterator[bytes]:
    for x in col:
        yield x.as_py() or b""


def _count(place: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place) + 1, dtype=np.int64)  # the last one for all other words
        for b in batches:
            for text in _texts(b.column(0)):
                words = WORD.findall(text.lower())
                total += np.bincount(np.fromiter((place.get(w, len(place)) for w in words), dtype=np.int64, count=len(words)), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(place)), pa.int32()), pa.array(total[:-1], pa.int64())], ["word", "n"])
    return run


def word_order(docs: DataFrame, text_col: str, vocabulary: Sequence[bytes]) -> dict[bytes, int]:
    """Rank of each word by its count in all texts, rarest first; ties in byte order."""
    names = sorted(vocabulary)
    counts = (docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(_count({w: k for k, w in enumerate(names)}), "word int, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect())  # one row a template word
    n = {r["word"]: r["n"] for r in counts}
    return {w: r for r, (_, w) in enumerate(sorted((n.get(k, 0), w) for k, w in enumerate(names)))}


BLOCKS = "array<struct<scale: int, block: long, tokens: array<int>>>"
SCANNED = f"id long, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks {BLOCKS}"
_BLOCKS = pa.list_(pa.struct([("scale", pa.int32()), ("block", pa.int64()), ("tokens", pa.list_(pa.int32()))]))


def _scan(rank: dict[bytes, int], phrases: list[tuple[list[int], str]], prefixes: dict[int, list[int]], least: dict[int, int]):
    """Base columns of each text and the blocks that hold a prefix word; words beyond ``rank`` count as -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {s: np.isin(np.arange(len(rank)), p) for s, p in prefixes.items()}
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in _texts(b.column(1)):
                words = WORD.findall(text.lower())
                ids = np.fromiter((rank.get(w, -1) for w in words), dtype=np.int32, count=len(words))
                known = np.flatnonzero(ids >= 0)
                starts, names = [], []
                for phrase, name in phrases:
                    at = known[ids[known] == phrase[0]]
                    for k, w in enumerate(phrase[1:], 1):
                        at = at[at + k < len(ids)]
                        at = at[ids[at + k] == w]
                    if len(at):
                        starts += at.tolist()
                        names.append(name)
                blocks = []
                for s, mask in wanted.items():
                    hit = known[mask[ids[known]]] // s
                    for k in np.unique(np.concatenate([hit, hit - 1])) if len(hit) else ():
                        tokens = np.unique(ids[k * s: (k + 2) * s])
                        tokens = tokens[tokens >= 0]
                        if k >= 0 and len(tokens) >= least[s]:
                            blocks.append({"scale": s, "block": int(k), "tokens": tokens})
                row = (len(words), len(starts), min(starts, default=None), max(starts, default=None), names, blocks)
                for col, x in zip(cols, row):
                    col.append(x)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), _BLOCKS]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             ["id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])
    return run


# ------------------------------------------------------------------ the join


def similar(blocks: DataFrame, templates: DataFrame, index: DataFrame) -> DataFrame:
    """``(row, scale, block, template, overlap)`` of every block and template that share ``need`` words.

    ``blocks``: (row, scale, block, tokens); ``templates``: (template, size, need, t_tokens); ``index``: a row
    (scale, token, t_at, template, size, need) for each prefix word. Tokens are ranks, in order."""
    probes = blocks.select("row", "scale", "block", "tokens", F.size("tokens").alias("held"), F.posexplode("tokens").alias("at", "token"))
    left = F.least(F.col("held") - F.col("at"), F.col("size") - F.col("t_at"))           # words from here on, on the poorer side
    pairs = (probes.join(sent_whole(index, F.lit(24)), ["scale", "token"])
             .where("held >= need")                                                      # length
             .where(F.col("at") <= F.col("held") - F.col("need"))                        # prefix of the block
             .where(left >= F.col("need"))                                               # position
             .groupBy("row", "scale", "block", "template").agg(F.first("tokens").alias("tokens")))
    return (pairs.join(sent_whole(templates, 4 * F.size("t_tokens")), "template")
            .withColumn("overlap", F.size(F.array_intersect("tokens", "t_tokens"))).where("overlap >= need")
            .select("row", "scale", "block", "template", "size", "overlap"))


def license_scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
                 percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, found)``, a row per document.

    ``score`` is 1 where a phrase stands, else the largest share of a template found; ``found`` lists
    (label, scale, block, share) of all pairs."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    sets = [(label, scale_of(len(words_of(t))), sorted(set(words_of(t)))) for label, t in templates if words_of(t)]
    spelled = [(words_of(p), label) for p, label in phrases if words_of(p)]
    rank = word_order(docs, text_col, {w for *_, s in sets for w in s} | {w for p, _ in spelled for w in p})

    sides, index, prefixes, least = [], [], {}, {}
    for k, (label, scale, s) in enumerate(sets):
        tokens, need = sorted(rank[w] for w in s), needed(len(s), percent)
        sides.append((k, label, len(s), need, tokens))
        least[scale] = min(need, least.get(scale, need))
        for at, token in enumerate(tokens[: len(s) - need + 1]):
            index.append((scale, token, at, k, len(s), need))
            prefixes.setdefault(scale, []).append(token)
    sides = spark.createDataFrame(sides, "template int, label string, size int, need int, t_tokens array<int>")
    index = spark.createDataFrame(index, "scale int, token int, t_at int, template int, size int, need int")

    scanned = scratch.write(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
        .mapInArrow(_scan(rank, [([rank[w] for w in p], label) for p, label in spelled], prefixes, least), SCANNED)
        .withColumn("row", F.monotonically_increasing_id()), "license-scanned")
    blocks = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.scale", "b.block", "b.tokens")
    share = F.col("overlap") / F.col("size")
    found = (similar(blocks, sides.drop("label"), index).join(F.broadcast(sides.select("template", "label")), "template")
             .groupBy("row").agg(F.collect_set("label").alias("more"), F.max(share).alias("share"),
                                 F.sort_array(F.collect_list(F.struct("label", "scale", "block", share.alias("share")))).alias("found")))
    out = attach(scanned.drop("blocks"), found, ["row"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
                      joined(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
                      F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"), "found")


def oracle(table: str = "documents", percent: int = PERCENT) -> str:
    """The registered query in DuckDB SQL, every block against every template."""
    def listed(xs) -> str:
        return "[" + ", ".join(f"'{x}'" for x in xs) + "]"

    spelled = [(words_of(p), label) for p, label in PHRASES]
    phrases = ", ".join(f"({listed(w.decode() for w in p)}, '{label}')" for p, label in spelled)
    sets = [(label, scale_of(len(words_of(t))), sorted(set(words_of(t)))) for label, t in TEMPLATES]
    templates = ", ".join(f"('{label}', {s}, {listed(w.decode() for w in ws)}, {needed(len(ws), percent)})" for label, s, ws in sets)
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}),
p(phrase, label) AS (VALUES {phrases}),
t(label, scale, words, need) AS (VALUES {templates}),
places AS (SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1: i + len(phrase)] = phrase)) AS place FROM d, p),
base AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list_distinct(list(label)) AS names FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, scale, list_distinct(w[k + 1: k + 2 * scale]) AS b
  FROM (SELECT doc_id, w, scale, unnest(range(0, len(w), scale)) AS k FROM d, (SELECT DISTINCT scale FROM t))),
found AS (SELECT doc_id, label, len(list_intersect(b, words)) AS n, need, len(words) AS size FROM blocks JOIN t USING (scale)),
more AS (SELECT doc_id, list_distinct(list(label)) AS names, max(n / size) AS share FROM found WHERE n >= need GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
  array_to_string(list_sort(coalesce(base.names, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.names, []), coalesce(more.names, [])))), ',') AS labels,
  CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""
