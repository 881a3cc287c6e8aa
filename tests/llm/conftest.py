import random

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
#: columns whose names operators use themselves
CLASH = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _id LONG, _tag STRING, key INT, score STRING, part INT, src INT"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    """Small documents with every odd case: nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(7)
    passage = " ".join(words(rng, 60, 10**6))
    rows = []
    for i in range(40):
        w = words(rng, rng.choice([3, 12, 80, 200]), 10**4)
        if i % 5 == 0:
            w[len(w) // 2: len(w) // 2] = passage.split()
        rows.append((i, " ".join(w) if i % 3 else "\n".join(" ".join(w[k: k + 7]) for k in range(0, len(w), 7))))
    base = words(rng, 300, 10**6)
    rows.append((40, " ".join(base)))
    rows.append((41, "  " + " ".join(base).replace(" ", "\t\n") + " "))   # equal after normalising
    for i in range(42, 52):                                              # near copies
        w = list(base)
        for _ in range(i - 41):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w)))
    rows.append((52, " ".join(base).upper()))
    rows += [(53, None), (54, ""), (55, " \t\n"), (56, "é ü 漢字   x\u0085y"), (57, "one"), (58, "One two three four")]
    rows += [(59, "one two three four"), (60, " ".join(base[:150])), (61, "\n".join(["The same old line here"] * 5)),
             (62, "  the SAME old line here\nanother line that stands alone"), (63, "a" * 3000), (64, "ab " * 900)]
    rows.append((64, "ab " * 900))                                       # a repeated row
    rows.append((None, " ".join(base)))                                  # no id
    rows.append((65, " ".join(words(rng, 30_000, 10**5))))               # very long
    return [(i, t, None if i is None or i % 11 == 0 else ("en", "de")[i % 2], None if i is not None and i % 13 == 0 else f"s{(i or 0) % 4}",
             len(t) if t is not None else None) for i, t in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus with extra columns that clash with names used inside."""
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3, 4) for r in rows], CLASH).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Rows by id; repeated ids give lists in the order of their values."""
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out
