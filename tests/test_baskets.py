import itertools
import math

from quarry.operators import baskets as bk

BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c", "d"],
           ["d"], ["a"], ["a", "b", "b"], []]


def _brute(baskets, s):
    sets = [set(b) for b in baskets]
    items = sorted(set().union(*sets))
    need = math.ceil(s * len(sets))
    out = {}
    for k in range(1, len(items) + 1):
        for combo in itertools.combinations(items, k):
            f = sum(1 for b in sets if set(combo) <= b)
            if f >= need:
                out[combo] = f
    return out


def _frame(spark):
    rows = [(i, it) for i, b in enumerate(BASKETS) for it in b] + [(len(BASKETS), None)]
    return bk.baskets(spark.createDataFrame(rows, "basket LONG, item STRING"))


def test_itemsets_match_brute_force(spark):
    model = bk.fit(_frame(spark), 0.3, 0.5)
    got = {tuple(r["items"]): r["freq"] for r in bk.frequent_itemsets(model).collect()}
    assert got == _brute(BASKETS, 0.3)


def test_order_and_limit(spark):
    model = bk.fit(_frame(spark), 0.2, 0.5)
    rows = bk.frequent_itemsets(model, 3).collect()
    keys = [(-r["size"], -r["freq"], ",".join(r["items"])) for r in rows]
    assert keys == sorted(keys) and len(rows) == 3
    every = [tuple(r["items"]) for r in bk.frequent_itemsets(model).collect()]
    assert [tuple(r["items"]) for r in rows] == every[:3] and len(every) > 3
    rules = bk.association_rules(model).collect()
    assert [r.asDict() for r in bk.association_rules(model, 2).collect()] == [r.asDict() for r in rules[:2]]
    assert len(bk.rule_interest(model, 1).collect()) == 1


def test_rules_and_interest(spark):
    bs = _frame(spark)
    model = bk.fit(bs, 0.2, 0.1)
    n = bs.count()
    fi = _brute(BASKETS, 0.2)
    for r in bk.rule_interest(model).collect():
        ante, cons = tuple(r["antecedent"]), tuple(r["consequent"])
        union = tuple(sorted(ante + cons))
        assert math.isclose(r["confidence"], fi[union] / fi[ante])
        assert math.isclose(r["interest"], abs(r["confidence"] - fi[cons] / n))
        assert r["freq"] == fi[cons]


def test_baskets_dedupe_items_and_skip_null(spark):
    rows = [(1, "x"), (1, "x"), (1, "y"), (2, None), (2, "z")]
    got = {r.basket: list(r["items"]) for r in bk.baskets(spark.createDataFrame(rows, "basket LONG, item STRING")).collect()}
    assert got == {1: ["x", "y"], 2: ["z"]}
