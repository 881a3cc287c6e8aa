import duckdb
import pytest

import __spark_entry__ as entry_mod
from quarry.sources.tables import TABLES

SF_CHECK = "/root/testdata/sf0.01"

# cheap queries checked against their oracle here; the full set runs in scripts/oracle_check.py
QUICK = ["top_k_groups", "intersect_sorted", "global_mean_rmse", "means_and_interaction",
         "frequent_itemsets_types", "frequent_itemsets", "association_rules", "rule_interest", "sq_distance",
         "kmeans_first_iter", "kmeans", "kmeans_customers", "kmeans_embeddings", "lsh_buckets", "predict_ratings", "als_rmse", "als_bias_rmse", "means_and_interaction_batches",
         "lsh_band_plan", "prime_keys", "to_csv_lines", "parse_ragged"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["park", "count"] and 0 < len(rows) <= 10


def test_every_query_has_oracle_or_is_known_non_sql():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) - set(entry_mod.LLM_QUERIES) == set()


ORDERED = ["distinct_sorted", "group_count", "top_k_groups", "intersect_sorted", "to_lines", "rows_head"]


@pytest.mark.parametrize("name", ORDERED)
def test_sorted_results_keep_their_order(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF_CHECK)
    res = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert [tuple(r[c] for c in cols) for r in df.collect()] == res.fetchall()


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF_CHECK)
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = sorted(tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted(tuple(_norm(r[idx[c]]) for c in sorted(ocols)) for r in res.fetchall())
    assert got == want
