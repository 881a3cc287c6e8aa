import re

import pytest

from quarry.llm import license_scan as ls
from tests.llm.brute import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = next(t for label, t in ls.TEMPLATES if label == "mit" and len(t) > 100)
SCHEMA = "doc_id LONG, text STRING, labels STRING, row LONG, blocks INT, n_words STRING, share DOUBLE"


def words(t):
    return WORD.findall(lower(t or ""))


def brute(rows, templates=ls.TEMPLATES, percent=90):
    out = []
    for i, t in rows:
        w = words(t)
        at = [(k, label) for p, label in ls.PHRASES for k in range(len(w)) if w[k: k + len(words(p))] == words(p)]
        base = {label for _, label in at}
        found = []
        for label, text in templates:
            s, scale = set(words(text)), ls.scale_of(len(words(text)))
            for k in range(0, len(w), scale):
                share = len(s & set(w[k: k + 2 * scale]))
                if s and 100 * share >= percent * len(s):
                    found.append((label, scale, k // scale, share / len(s)))
        labels = base | {f[0] for f in found}
        score = 1.0 if at else max((f[3] for f in found), default=0.0)
        out.append((i, len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(found)))
    return sorted(out, key=str)


def licensed():
    noise = " ".join(f"w{k}" for k in range(700))
    mit = words(MIT)
    return [
        (200, "Licensed under the Apache License, Version 2.0."), (201, "x\nReleased under the\nMIT License.\ny"), (202, "GNU General Public License, MIT license; cc-by"),
        (203, noise + " " + MIT + " " + noise), (204, MIT[: len(MIT) * 19 // 20]), (205, MIT[: len(MIT) // 2]),
        (206, " ".join(w for k, w in enumerate(mit) if k % 12)), (207, noise + " " + " ".join(reversed(mit))),
        (208, ("Licensed under CC BY-NC 4.0. " + noise + "\n") * 4), (209, "license apache mit cc gnu by"), (210, "MIT License"), (210, "MIT License"),
        (None, "Licensed under the GNU General Public License, version 3"), (211, "the of under license version " * 300),
        (212, "LICENSED under the apache LİCENSE version 2 0"), (213, "ccé by cc by"),
    ]


def rows_of(df):
    return sorted(((*(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")),
                    sorted(tuple(f) for f in r["found"] or [])) for r in df.collect()), key=str)


def test_as_brute_force(spark, rows):
    given = [r[:2] for r in rows] + licensed()
    got = ls.license_scan(spark.createDataFrame([(*r, "a", 1, 2, "b", 0.5) for r in given], SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    want = brute(given)
    assert rows_of(got) == want
    by = {r[0]: r[6] for r in want}
    assert by[200] == "apache,apache-2.0" and by[203] == by[204] == by[207] == "mit" and by[205] == by[209] == ""


@pytest.mark.parametrize("percent", [1, 50, 100])
def test_any_threshold_and_templates(spark, percent):
    templates = [("a", "one two three four"), ("b", "two two three"), ("c", ""), ("d", " ".join(f"w{k}" for k in range(0, 60))), ("e", "one")]
    given = licensed() + [(1, "one two three"), (2, "three two"), (3, "four"), (4, " ".join(f"w{k}" for k in range(20, 70)))]
    got = ls.license_scan(spark.createDataFrame([(*r, "a", 1, 2, "b", 0.5) for r in given], SCHEMA), templates, percent=percent)
    assert rows_of(got) == brute(given, templates, percent)


def test_empty(spark, empty):
    assert ls.license_scan(empty).count() == 0
    one = spark.createDataFrame([(1, "MIT License")], "doc_id LONG, text STRING")
    assert [r["labels"] for r in ls.license_scan(one, []).collect()] == ["mit"]


def test_prefix_order_is_by_count(spark):
    docs = spark.createDataFrame([(1, "b b b a c c"), (2, "c C x")], "doc_id LONG, text STRING")
    assert ls.word_order(docs, "text", [b"a", b"b", b"c", b"zz"]) == {b"zz": 0, b"a": 1, b"b": 2, b"c": 3}
