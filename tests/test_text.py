from quarry.operators import text


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "entity LONG, text STRING")


def test_shingles_whole_text_and_short_texts(spark):
    docs = _docs(spark, ["a b  c\td\n e", "x y", "", "   ", "solo", "a b c"])
    occ = sorted((r.entity, r.feature) for r in text.shingle_occurrences(docs, 3).collect())
    assert occ == [(0, "a b c"), (0, "b c d"), (0, "c d e"), (1, "x y"), (4, "solo"), (5, "a b c")]


def test_repeated_shingles_are_kept(spark):
    docs = _docs(spark, ["p q r p q r"])
    assert sorted(r.feature for r in text.shingle_occurrences(docs, 3).collect()) == ["p q r", "p q r", "q r p", "r p q"]
