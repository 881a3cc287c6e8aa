from pyspark.sql import functions as F

from quarry.operators import relational as rel


def _parks(spark, values):
    return spark.createDataFrame([(v,) for v in values], "park STRING")


def test_count_rows_and_empty(spark):
    df = _parks(spark, ["a", None, "", "b"])
    assert rel.count_rows(df).first()["n_rows"] == 4
    assert rel.count_rows(df.limit(0)).first()["n_rows"] == 0
    assert rel.count_present(df.limit(0), "park").first()["n_present"] == 0


def test_present_excludes_null_and_empty(spark):
    df = _parks(spark, ["a", None, "", "b", "a"])
    assert rel.count_present(df, "park").first()["n_present"] == 3
    assert [r.park for r in rel.distinct_sorted(df, "park").collect()] == ["a", "b"]


def test_code_point_order(spark):
    df = _parks(spark, ["Prével", "PARC", "parc", "Zoo", "Ébène"])
    got = [r.park for r in rel.distinct_sorted(df, "park").collect()]
    assert got == sorted(["Prével", "PARC", "parc", "Zoo", "Ébène"])


def test_group_count_weighted_equals_plain(spark):
    rows = ["x"] * 5 + ["y"] * 3 + [None] * 2
    df = _parks(spark, rows)
    plain = {r.park: r["count"] for r in rel.group_count(df, "park").collect()}
    pre = df.groupBy("park").agg(F.count(F.lit(1)).alias("n"))
    weighted = {r.park: r["count"] for r in rel.group_count(pre, "park", weight="n").collect()}
    assert plain == weighted == {"x": 5, "y": 3}


def test_top_k_tie_at_cut_and_fewer_groups(spark):
    rows = ["b"] * 3 + ["a"] * 3 + ["c"] * 3 + ["d"] * 5
    df = _parks(spark, rows)
    top = [(r.park, r["count"]) for r in rel.top_k_groups(df, "park", k=3).collect()]
    assert top == [("d", 5), ("a", 3), ("b", 3)]
    few = rel.top_k_groups(_parks(spark, ["q"]), "park", k=10).collect()
    assert [(r.park, r["count"]) for r in few] == [("q", 1)]


def test_intersection_ignores_absent_and_duplicates(spark):
    a = _parks(spark, ["x", "y", None, "", "y"])
    b = _parks(spark, ["y", None, "", "z", "x", "x"])
    assert [r.park for r in rel.intersect_sorted(a, b, "park").collect()] == ["x", "y"]
    c = _parks(spark, ["none"])
    assert rel.intersect_sorted(a, c, "park").count() == 0


def test_union_keeps_duplicates_and_filters(spark):
    a = spark.createDataFrame([(1,), (2,)], "k INT")
    assert rel.union_all(a, a).count() == 4
    r = spark.range(10).withColumnRenamed("id", "k")
    assert rel.filter_range(r, "k", 3, 6).count() == 3
    assert rel.filter_in(r, "k", [1, 2, 42]).count() == 2
    assert rel.filter_in(r, "k", a).count() == 2


def test_bounded_side_broadcasts_only_under_the_bound(spark):
    import io
    from contextlib import redirect_stdout

    from quarry.session import bounded_side

    big = spark.range(10000).withColumnRenamed("id", "k")
    small = spark.range(100).withColumnRenamed("id", "k")

    def plan(df):
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    assert "BroadcastHashJoin" in plan(big.join(bounded_side(small, 100, bound=1000), "k"))
    merged = plan(big.join(bounded_side(small, 100, bound=10), "k"))
    assert "SortMergeJoin" in merged and "BroadcastHashJoin" not in merged
