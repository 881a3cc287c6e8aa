import random

from quarry.functions import py_float_str


def test_py_float_str_matches_python(spark):
    rng = random.Random(3)
    vals = [0.0, -0.0, 1.0, -1.0, 0.5, 3.0, 12345678.0, 1e7, 9999999.0, 1e15, 1.5e16, 1e16, 1e17, 123456789012.5,
            1e-3, 5e-4, 1e-4, 9.99e-5, 1e-5, 1.234e-7, 2.5e-300, 1.7976931348623157e308, 0.1, 0.9860296172115116,
            1.56, 1.0409172341247102, -7.25e-6, -3.5e12, 4.9e-324, float("nan"), float("inf"), float("-inf")]
    vals += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i INT, x DOUBLE")
    got = {r.i: r.s for r in df.select("i", py_float_str("x").alias("s")).collect()}
    for i, v in enumerate(vals):
        assert got[i] == str(v), (v, got[i])
    assert spark.createDataFrame([(None,)], "x DOUBLE").select(py_float_str("x").alias("s")).first().s is None


def test_py_float_str_is_shortest_and_reads_back(spark):
    rng = random.Random(8)
    vals = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x DOUBLE")
    rows = df.select("x", py_float_str("x").alias("s")).collect()
    assert all(float(r.s) == r.x and len(r.s) == len(str(r.x)) for r in rows)
    assert sum(r.s != str(r.x) for r in rows) <= 20
