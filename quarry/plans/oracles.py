"""``oracle_sql()`` of the driver contract: DuckDB SQL per query name.

Written against the pre-registered views (``lineitem``, ``part``, ...), one
statement per query, with the same output column names as ``queries.py``.
DuckDB's ``sum`` of integers is HUGEINT, so counts are cast to BIGINT.
"""

from __future__ import annotations

import functools
import math
import random

ORACLES: dict[str, str] = {}

PARK = ("CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_brand = 'Brand#2' THEN '' "
        "ELSE p_name END")
TREES = f"(SELECT {PARK} AS park FROM lineitem JOIN part ON l_partkey = p_partkey)"
PRESENT = "park IS NOT NULL AND park <> ''"

ORACLES["count_rows"] = f"SELECT count(*) AS n_rows FROM {TREES} t"
ORACLES["count_present"] = (
    f"SELECT CAST(count(*) FILTER (WHERE {PRESENT}) AS BIGINT) AS n_present FROM {TREES} t")
ORACLES["distinct_sorted"] = (
    f"SELECT DISTINCT park FROM {TREES} t WHERE {PRESENT} ORDER BY park")
ORACLES["group_count"] = (
    f"SELECT park, count(*) AS count FROM {TREES} t WHERE {PRESENT} GROUP BY park ORDER BY park")
ORACLES["top_k_groups"] = (
    f"SELECT park, count(*) AS count FROM {TREES} t WHERE {PRESENT} "
    "GROUP BY park ORDER BY count DESC, park ASC LIMIT 10")
ORACLES["intersect_sorted"] = """
SELECT o_custkey FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders WHERE year(o_orderdate) = 1995
  INTERSECT
  SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE year(o_orderdate) = 2001
) ORDER BY o_custkey"""
ORACLES["union_all"] = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity < 25
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount < 0.05"""
ORACLES["distinct"] = (
    "SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders")
ORACLES["rows_head"] = (
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 20")
ORACLES["filter_in"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem "
    "WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5)")
ORACLES["filter_range"] = (
    "SELECT o_orderkey FROM orders WHERE o_totalprice >= 1000.0 AND o_totalprice < 50000.0")
ORACLES["filter_equal"] = "SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#13'"

# ---------------------------------------------------------------- recommenders
BUCKET = "(CAST(concat('0x', substr(md5(concat('123', ':', key)), 1, 8)) AS BIGINT) % 100)"
RATINGS = f"""(SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey) AS key,
  o_custkey AS userId, l_partkey AS movieId, CAST(l_quantity AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SPLIT = f"(SELECT *, {BUCKET} < 80 AS is_train FROM {RATINGS} r0)"
TRAIN = f"(SELECT * FROM {SPLIT} s0 WHERE is_train)"
TEST = f"(SELECT * FROM {SPLIT} s1 WHERE NOT is_train)"
G = f"(SELECT avg(rating) FROM {TRAIN} tg)"
UM = f"(SELECT userId, avg(rating) AS user_mean FROM {TRAIN} tu GROUP BY userId)"
IM = f"(SELECT movieId, avg(rating) AS item_mean FROM {TRAIN} ti GROUP BY movieId)"
BIAS = f"""(SELECT t.key, t.userId, t.movieId, t.rating,
  um.user_mean + im.item_mean - {G} AS prediction
  FROM {TEST} t JOIN {IM} im USING (movieId) JOIN {UM} um USING (userId))"""

ORACLES["split_by_key"] = f"SELECT key, is_train FROM {SPLIT} s"
ORACLES["global_avg"] = f"SELECT round(avg(rating), 6) AS global_mean FROM {TRAIN} t"
ORACLES["group_avg"] = f"SELECT userId, round(user_mean, 6) AS user_mean FROM {UM} u"
ORACLES["global_mean_rmse"] = (
    f"SELECT round(sqrt(avg((rating - {G}) * (rating - {G}))), 6) AS rmse FROM {TEST} t")
ORACLES["means_and_interaction"] = f"""
SELECT userId, movieId, rating, round(user_mean, 6) AS user_mean, round(item_mean, 6) AS item_mean,
       round(rating - (user_mean + item_mean - {G}), 6) AS user_item_interaction
FROM {TRAIN} t JOIN {IM} im USING (movieId) JOIN {UM} um USING (userId)
ORDER BY userId, movieId, key LIMIT 50"""
ORACLES["means_and_interaction_batches"] = f"""
SELECT key, userId, movieId, rating, round(user_mean, 6) AS user_mean, round(item_mean, 6) AS item_mean,
       round(rating - (user_mean + item_mean - {G}), 6) AS user_item_interaction
FROM {TRAIN} t JOIN {IM} im USING (movieId) JOIN {UM} um USING (userId)"""
ORACLES["bias_predict"] = (
    f"SELECT key, userId, movieId, rating, round(prediction, 6) AS prediction FROM {BIAS} p")
ORACLES["rmse"] = (
    f"SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse FROM {BIAS} p")

PAIRS = f"""(SELECT *, {BUCKET.replace('key', "concat_ws(':', userId, movieId)")} < 80 AS is_train
  FROM (SELECT userId, movieId, avg(rating) AS rating FROM {RATINGS} pr GROUP BY userId, movieId) p0)"""
G_P, UM_P, IM_P = (f"(SELECT {what} FROM p WHERE is_train {by})" for what, by in (
    ("avg(rating)", ""), ("userId, avg(rating) AS user_mean", "GROUP BY userId"), ("movieId, avg(rating) AS item_mean", "GROUP BY movieId")))

# ---------------------------------------------------------------- baskets
def pylist(lst: str) -> str:
    """DuckDB twin of ``py_list_str``: a list rendered as Python prints it."""
    return f"(CASE WHEN len({lst}) = 0 THEN '[]' ELSE '[''' || array_to_string({lst}, ''', ''') || ''']' END)"


def _bi(col: str) -> str:
    return (f"(SELECT DISTINCT l_orderkey AS basket, {col} AS item "
            "FROM lineitem JOIN part ON l_partkey = p_partkey)")


ORACLES["baskets"] = f"""
SELECT basket, {pylist('list_sort(list(item))')} AS items FROM {_bi('p_brand')} bi GROUP BY basket"""

# level-wise itemsets up to size 3 (no itemset of size 3 is frequent at this support,
# so none of size 4 can be)
ORACLES["frequent_itemsets"] = f"""
WITH bi AS {_bi('p_brand')},
th AS (SELECT ceil(0.02 * count(DISTINCT basket)) AS t FROM bi),
f AS (
  SELECT [item] AS items, count(*) AS freq FROM bi GROUP BY item
  UNION ALL
  SELECT [a.item, b.item], count(*) FROM bi a JOIN bi b ON a.basket = b.basket AND a.item < b.item
  GROUP BY a.item, b.item
  UNION ALL
  SELECT [a.item, b.item, c.item], count(*) FROM bi a
  JOIN bi b ON a.basket = b.basket AND a.item < b.item
  JOIN bi c ON c.basket = a.basket AND b.item < c.item
  GROUP BY a.item, b.item, c.item)
SELECT {pylist('items')} AS items, freq FROM f
WHERE freq >= (SELECT t FROM th)
ORDER BY len(items) DESC, freq DESC, array_to_string(items, ',')"""

# every subset of the 6 part types as a bit mask, tested against basket masks
TYPE_FI = f"""
ty AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS bit
       FROM (SELECT DISTINCT p_type FROM part)),
bm AS (SELECT basket, bit_or(CAST(1 AS BIGINT) << bit) AS mask
       FROM {_bi('p_type')} bi JOIN ty ON item = p_type GROUP BY basket),
nb AS (SELECT count(*) AS n FROM bm),
sub AS (SELECT range AS s FROM range(1, CAST(1 AS BIGINT) << (SELECT count(*) FROM ty))),
fs AS (SELECT s, count(*) AS freq FROM sub JOIN bm ON (mask & s) = s GROUP BY s
       HAVING count(*) >= ceil({0.05} * (SELECT n FROM nb))),
fi AS (SELECT s, freq, list(p_type ORDER BY p_type) AS items FROM fs JOIN ty ON ((s >> bit) & 1) = 1
       GROUP BY s, freq),
rules AS (SELECT a.items AS antecedent, [t.p_type] AS consequent,
                 u.freq / a.freq AS confidence, u.s AS s, t.bit AS cbit
          FROM fi u JOIN ty t ON ((u.s >> t.bit) & 1) = 1
          JOIN fi a ON a.s = u.s - (CAST(1 AS BIGINT) << t.bit)
          WHERE u.freq / a.freq >= 0.3)"""

ORACLES["frequent_itemsets_types"] = f"""
WITH {TYPE_FI}
SELECT {pylist('items')} AS items, freq FROM fi"""
ORACLES["association_rules"] = f"""
WITH {TYPE_FI}
SELECT {pylist('antecedent')} AS antecedent, {pylist('consequent')} AS consequent,
       round(confidence, 6) AS confidence FROM rules
ORDER BY len(antecedent) DESC, confidence DESC, array_to_string(antecedent, ','),
         array_to_string(consequent, ',')"""
ORACLES["rule_interest"] = f"""
WITH {TYPE_FI}
SELECT {pylist('antecedent')} AS antecedent, {pylist('consequent')} AS consequent,
       round(confidence, 6) AS confidence, {pylist('c.items')} AS items, c.freq AS freq,
       round(abs(confidence - c.freq / (SELECT n FROM nb)), 6) AS interest
FROM rules JOIN fi c ON c.s = (CAST(1 AS BIGINT) << cbit)
ORDER BY len(antecedent) DESC, abs(confidence - c.freq / (SELECT n FROM nb)) DESC,
         array_to_string(antecedent, ','), array_to_string(consequent, ',')"""


# ---------------------------------------------------------------- clustering
NATION_PARTS = """SELECT DISTINCT n_name AS entity, l_partkey AS feature
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
CUSTOMER_BRANDS = """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS entity, p_brand AS feature
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
SUPPLIER_NATION_PARTS = """SELECT DISTINCT n_name AS entity, l_partkey AS feature
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
TRADE_PAIRS = """SELECT DISTINCT n1.n_name AS entity1, n2.n_name AS entity2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation n1 ON s_nationkey = n1.n_nationkey JOIN nation n2 ON c_nationkey = n2.n_nationkey
  WHERE n1.n_name < n2.n_name"""


def start_sql(k: int, seed: int = 123) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY entity) - 1 AS INTEGER) AS cluster, entity
  FROM (SELECT entity FROM (SELECT DISTINCT entity FROM inc)
        ORDER BY md5(concat('{seed}', ':', entity)), entity LIMIT {k})"""


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def kmeans_ctes(inc_sql: str, k: int, passes: int, seed: int = 123, valued: bool = False) -> str:
    """CTE chain: start, then ``passes`` rounds of update + assign.

    Distances are plain sums of squared component differences over all
    features, rounded to 9 decimals; ties go to the smaller cluster.
    ``valued``: ``inc`` carries a double ``value`` column (real vectors)."""
    x = "value" if valued else "1.0::DOUBLE"
    out = [f"inc AS MATERIALIZED (SELECT entity, feature, {x} AS x FROM ({inc_sql}))",
           "en AS MATERIALIZED (SELECT DISTINCT entity FROM inc)", "fe AS MATERIALIZED (SELECT DISTINCT feature FROM inc)",
           f"st AS MATERIALIZED ({start_sql(k, seed)})",
           "c0 AS MATERIALIZED (SELECT st.cluster, fe.feature, coalesce(inc.x, 0) AS w FROM st CROSS JOIN fe "
           "LEFT JOIN inc ON inc.entity = st.entity AND inc.feature = fe.feature)"]

    def assign(j):
        return (f"a{j} AS MATERIALIZED (SELECT entity, arg_min(cluster, (dist, cluster)) AS cluster FROM ("
                f"SELECT g.entity, g.cluster, round(sum((coalesce(i.x, 0) - g.w) * (coalesce(i.x, 0) - g.w)), 9) AS dist "
                f"FROM (SELECT en.entity, c.* FROM en CROSS JOIN c{j} c) g LEFT JOIN inc i USING (entity, feature) "
                f"GROUP BY g.entity, g.cluster) GROUP BY entity)")

    out.append(assign(0))
    for j in range(1, passes + 1):
        p = j - 1
        out.append(f"c{j} AS MATERIALIZED (SELECT o.cluster, o.feature, CASE WHEN z.n IS NULL THEN o.w ELSE coalesce(s.t, 0) / z.n END AS w "
                   f"FROM c{p} o LEFT JOIN (SELECT cluster, count(*) AS n FROM a{p} GROUP BY cluster) z USING (cluster) "
                   f"LEFT JOIN (SELECT a.cluster, i.feature, sum(i.x) AS t FROM inc i JOIN a{p} a USING (entity) "
                   f"GROUP BY a.cluster, i.feature) s ON s.cluster = o.cluster AND s.feature = o.feature)")
        out.append(assign(j))
    return "WITH " + ",\n".join(out)


def classes_sql(inc_sql: str, k: int, passes: int, valued: bool = False) -> str:
    """Classes after ``passes`` rounds; an error unless the last one moved nothing."""
    p = passes
    moved = f"(SELECT count(*) FROM a{p} x JOIN a{p - 1} y USING (entity) WHERE x.cluster <> y.cluster)"
    return (kmeans_ctes(inc_sql, k, p, valued=valued) +
            f"\nSELECT l.leader, a.entity AS member FROM a{p} a JOIN "
            f"(SELECT cluster, min(entity) AS leader FROM a{p} GROUP BY cluster) l USING (cluster) "
            f"WHERE CASE WHEN {moved} > 0 THEN error('entities still move') ELSE true END")


ORACLES["incidence_lookup"] = f"""
SELECT q.entity, q.feature, (i.entity IS NOT NULL) AS present
FROM ({SUPPLIER_NATION_PARTS}) q LEFT JOIN ({NATION_PARTS}) i
  ON i.entity = q.entity AND i.feature = q.feature"""
ORACLES["sq_distance"] = f"""
WITH inc AS ({NATION_PARTS}), nx AS (SELECT entity, count(*) AS nx FROM inc GROUP BY entity)
SELECT p.entity1, p.entity2,
  CAST(coalesce(n1.nx, 0) + coalesce(n2.nx, 0) - 2 * coalesce(
    (SELECT count(*) FROM inc a JOIN inc b ON a.feature = b.feature
     WHERE a.entity = p.entity1 AND b.entity = p.entity2), 0) AS BIGINT) AS distance
FROM ({TRADE_PAIRS}) p LEFT JOIN nx n1 ON n1.entity = p.entity1 LEFT JOIN nx n2 ON n2.entity = p.entity2"""
ORACLES["init_centroids"] = f"WITH inc AS ({NATION_PARTS}) {start_sql(3)}"
ORACLES["kmeans_first_iter"] = (
    kmeans_ctes(NATION_PARTS, 3, 0) +
    "\nSELECT st.entity AS centroid, a0.entity AS member FROM a0 JOIN st USING (cluster)")
ORACLES["kmeans_update"] = (
    kmeans_ctes(NATION_PARTS, 3, 1) +
    "\nSELECT cluster, feature, round(w, 6) AS weight FROM c1 WHERE w > 0")
# passes until nothing moves at sf0.01; the SQL raises if entities still move
ORACLES["kmeans"] = classes_sql(NATION_PARTS, 3, 1)
ORACLES["kmeans_customers"] = classes_sql(CUSTOMER_BRANDS, 5, 40)
EMBEDDING_VALUES = """SELECT vec_id AS entity, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS feature,
  CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings"""
ORACLES["kmeans_embeddings_first_iter"] = (
    kmeans_ctes(EMBEDDING_VALUES, 10, 0, valued=True) +
    "\nSELECT st.entity AS centroid, a0.entity AS member FROM a0 JOIN st USING (cluster)")
ORACLES["kmeans_embeddings"] = classes_sql(EMBEDDING_VALUES, 10, 11, valued=True)


# ---------------------------------------------------------------- primes / hashing / LSH
# The driver checks oracles at sf0.01. Hash parameters depend on a row count
# (m) of that data and on Python's seeded RNG, which SQL cannot express, so
# the family is computed here and inlined as VALUES; everything else is SQL.

ORACLE_DIR = "/root/testdata/sf0.01"


@functools.lru_cache(maxsize=None)
def _scalar(sql: str) -> int:
    import duckdb

    return int(_check_data(duckdb).execute(sql).fetchone()[0])


def _check_data(duckdb):
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in ("part", "documents", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ORACLE_DIR}/{t}.parquet')")
    return con


def _is_prime(v: int) -> bool:
    return v >= 2 and all(v % d for d in range(2, math.isqrt(v) + 1))


def _family(seed: int, n: int, m: int) -> str:
    rng = random.Random(seed)
    ps, v = [], max(m, 2)
    while len(ps) < n:
        if _is_prime(v):
            ps.append(v)
        v += 1
    rows = []
    for i, p in enumerate(ps):
        a = rng.randint(1, m)
        b = rng.randint(1, m)
        rows.append(f"({i}, {a}, {b}, {p})")
    return f"(SELECT CAST(i AS INTEGER) AS i, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, CAST(p AS BIGINT) AS p FROM (VALUES {', '.join(rows)}) v(i, a, b, p))"


def _lazy(fn):
    """Register an oracle whose text needs the data (built on first access)."""
    _LAZY[fn.__name__.removeprefix("o_")] = fn
    return fn


_LAZY: dict = {}

NO_DIVISOR = "NOT EXISTS (SELECT 1 FROM range(2, CAST(floor(sqrt({k})) AS BIGINT) + 1) d(d) WHERE {k} % d = 0)"

ORACLES["prime_keys"] = (
    "SELECT o_orderkey FROM orders WHERE o_orderkey >= 2 AND "
    + NO_DIVISOR.format(k="o_orderkey"))
ORACLES["next_primes"] = f"""
SELECT CAST(row_number() OVER (ORDER BY p) - 1 AS INTEGER) AS i, p FROM (
  SELECT v AS p FROM range((SELECT count(*) FROM part), (SELECT count(*) FROM part) + 100000) t(v)
  WHERE v >= 2 AND {NO_DIVISOR.format(k='v')} ORDER BY v LIMIT 50)"""

# all primes to a little beyond the largest price, then the three that follow each price
ORACLES["primes_from"] = """
WITH st AS (SELECT DISTINCT greatest(CAST(floor(o_totalprice) AS BIGINT), 2) AS start FROM orders),
top AS (SELECT max(start) + 2000 AS hi FROM st),
base AS MATERIALIZED (SELECT v AS q FROM range(2, (SELECT CAST(floor(sqrt(hi)) AS BIGINT) + 1 FROM top)) t(v)
  WHERE NOT EXISTS (SELECT 1 FROM range(2, CAST(floor(sqrt(v)) AS BIGINT) + 1) d(d) WHERE v % d = 0)),
comp AS (SELECT DISTINCT unnest(range(q * q, (SELECT hi FROM top) + 1, q)) AS v FROM base),
pr AS MATERIALIZED (SELECT v AS p, row_number() OVER (ORDER BY v) AS k FROM range(2, (SELECT hi FROM top) + 1) t(v) WHERE v NOT IN (SELECT v FROM comp)),
f AS (SELECT start, k FROM st ASOF JOIN pr ON st.start <= pr.p)
SELECT start, CAST(pr.k - f.k AS INTEGER) AS i, p FROM f JOIN pr ON pr.k BETWEEN f.k AND f.k + 2"""

PART_M = "SELECT count(*) FROM part"
PART_IDX = "(SELECT p_partkey AS feature, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part)"


@_lazy
def o_hash_column():
    fam = _family(123, 1, _scalar(PART_M))
    return f"SELECT p_partkey, (f.a * p_partkey + f.b) % f.p AS h FROM part, {fam} f"


@_lazy
def o_hash_family_apply():
    fam = _family(123, 10, _scalar(PART_M))
    return f"SELECT p_partkey, f.i, (f.a * p_partkey + f.b) % f.p AS h FROM part, {fam} f"


def _nation_sig(n: int) -> str:
    fam = _family(123, n, _scalar(PART_M))
    return (f"(SELECT entity, f.i, min((f.a * x.idx + f.b) % f.p) AS h "
            f"FROM ({NATION_PARTS}) inc JOIN {PART_IDX} x USING (feature), {fam} f GROUP BY entity, f.i)")


def _bands(sig: str, r: int) -> str:
    return (f"(SELECT entity, CAST(i // {r} AS INTEGER) AS band, "
            f"md5(string_agg(CAST(h AS VARCHAR), ',' ORDER BY i)) AS bucket FROM {sig} s GROUP BY entity, i // {r})")


def _buckets(bands: str) -> str:
    return (f"WITH bd AS {bands}, sz AS (SELECT band, bucket, count(*) AS size FROM bd GROUP BY band, bucket "
            f"HAVING count(*) >= 2) SELECT band, bucket, entity AS member, size FROM bd JOIN sz USING (band, bucket)")


@_lazy
def o_minhash_signatures():
    return f"SELECT entity, i, h FROM {_nation_sig(35)} s"


@_lazy
def o_band_hash():
    return f"SELECT entity, bucket FROM {_bands(_nation_sig(12), 2)} b WHERE band = 2"


@_lazy
def o_lsh_buckets():
    return _buckets(_bands(_nation_sig(35), 7))


ORACLES["lsh_band_plan"] = """
WITH req AS (SELECT DISTINCT CAST(l_partkey AS BIGINT) + 1 AS n, 1.0::DOUBLE - l_discount AS s FROM lineitem),
bb AS (SELECT n, s, list_max(list_filter(range(1, n + 1),
    lambda b: CAST(b AS DOUBLE) * ln(CAST(b AS DOUBLE)) <= -CAST(n AS DOUBLE) * ln(s))) AS b FROM req)
SELECT n, round(s, 9) AS s, b, n // b AS r, (n // b) * b AS n_real,
       round(pow(1.0::DOUBLE / b, 1.0::DOUBLE / (n // b)), 9) AS s_real FROM bb"""

DOC_WORDS = "list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\x0B]+'), lambda w: w <> '')"
DOC_INC = f"""(SELECT DISTINCT entity, feature FROM (
  SELECT doc_id AS entity, unnest(CASE WHEN len(w) >= 3
           THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS feature
  FROM (SELECT doc_id, {DOC_WORDS} AS w FROM documents)))"""


@_lazy
def o_doc_lsh_buckets():
    m = _scalar(f"SELECT count(DISTINCT feature) FROM {DOC_INC} d")
    fam = _family(123, 40, m)
    idx = f"(SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (SELECT DISTINCT feature FROM {DOC_INC} d0))"
    sig = (f"(SELECT entity, f.i, min((f.a * x.idx + f.b) % f.p) AS h FROM {DOC_INC} inc "
           f"JOIN {idx} x USING (feature), {fam} f GROUP BY entity, f.i)")
    return _buckets(_bands(sig, 4))


# ---------------------------------------------------------------- ALS
# Start factors come from Spark's seeded generator, which SQL cannot express; a second
# implementation (als_check) draws them, and at rank 70 fits on the check data as well.
# Its predictions are inlined; the split, means and errors are computed in SQL.

ALS_RANK, ALS_STEPS, ALS_REG, ALS_BLOCKS = 70, 5, 0.01, 10


@functools.lru_cache(maxsize=None)
def _als_predictions(target: str) -> str:
    """``(userId, movieId, x)``: predicted ``target`` of every test pair with known ids."""
    import duckdb
    import numpy as np

    from quarry.plans import als_check

    con = _check_data(duckdb)
    train = con.execute(f"WITH p AS {PAIRS} SELECT userId, movieId, {target} AS t FROM p JOIN {UM_P} USING (userId) "
                        f"JOIN {IM_P} USING (movieId) WHERE is_train").fetchnumpy()
    test = con.execute(f"WITH p AS {PAIRS} SELECT userId, movieId FROM p WHERE NOT is_train").fetchnumpy()
    users, x, items, y = als_check.fit(train["userId"], train["movieId"], train["t"], 123, ALS_RANK, ALS_STEPS, ALS_REG, ALS_BLOCKS)
    known = np.isin(test["userId"], users) & np.isin(test["movieId"], items)
    u, i = test["userId"][known], test["movieId"][known]
    value = (x[np.searchsorted(users, u)].astype(float) * y[np.searchsorted(items, i)]).sum(axis=1)
    rows = ", ".join(f"({a}, {b}, {v:.9f}::DOUBLE)" for a, b, v in zip(u.tolist(), i.tolist(), value.tolist()))
    return f"(SELECT * FROM (VALUES {rows}) v(userId, movieId, x))"


@_lazy
def o_als_rmse():
    return (f"WITH p AS {PAIRS} SELECT round(sqrt(avg((rating - x) * (rating - x))), 4) AS rmse, count(*) AS n_predicted "
            f"FROM p JOIN {_als_predictions('rating')} v USING (userId, movieId) WHERE NOT is_train")


@_lazy
def o_als_bias_rmse():
    e = f"(rating - (x + user_mean + item_mean - {G_P}))"
    v = _als_predictions(f"rating - (user_mean + item_mean - {G_P})")
    return (f"WITH p AS {PAIRS} SELECT round(sqrt(avg({e} * {e})), 4) AS rmse, count(*) AS n_predicted FROM p "
            f"JOIN {v} v USING (userId, movieId) JOIN {UM_P} USING (userId) JOIN {IM_P} USING (movieId) WHERE NOT is_train")


@_lazy
def o_predict_ratings():
    """The whole fit of rank 1: ten half steps, each an aggregate; factors are 32-bit floats."""
    import duckdb
    import numpy as np

    from quarry.plans import als_check

    users = _check_data(duckdb).execute(f"WITH p AS {PAIRS} SELECT DISTINCT userId FROM p WHERE is_train").fetchnumpy()["userId"]
    start = als_check.start_factors(np.asarray(users), 1, 123, ALS_BLOCKS)
    rows = ", ".join(f"({u}, {float(f[0])!r})" for u, f in sorted(start.items()))
    steps = [f"x0 AS (SELECT userId, CAST(x AS FLOAT) AS x FROM (VALUES {rows}) v(userId, x))"]
    for k in range(1, ALS_STEPS + 1):
        for new, key, old, other, prev in (("y", "movieId", "x", "userId", k - 1), ("x", "userId", "y", "movieId", k)):
            f = f"{old}{prev}"
            steps.append(f"{new}{k} AS MATERIALIZED (SELECT {key}, CAST(sum(r * {f}.{old}::DOUBLE) / (sum({f}.{old}::DOUBLE * {f}.{old}::DOUBLE) "
                         f"+ {ALS_REG} * count(*)) AS FLOAT) AS {new} FROM t JOIN {f} USING ({other}) GROUP BY {key})")
    return (f"WITH p AS MATERIALIZED {PAIRS}, t AS (SELECT userId, movieId, CAST(CAST(rating AS FLOAT) AS DOUBLE) AS r FROM p WHERE is_train), "
            + ",\n".join(steps) + f"\nSELECT userId, movieId, round(rating, 6) AS rating, round(CAST(x * y AS DOUBLE), 6) AS prediction "
            f"FROM p JOIN x{ALS_STEPS} USING (userId) JOIN y{ALS_STEPS} USING (movieId) WHERE NOT is_train")


def all_oracles() -> dict[str, str]:
    out = dict(ORACLES)
    for name, fn in _LAZY.items():
        out[name] = fn()
    return out


# ---------------------------------------------------------------- sources and sinks
PART_CSV = (f"SELECT p_partkey, concat_ws(', ', p_name, p_brand) AS label, {PARK} AS park, "
            "p_size, p_retailprice FROM part")
ORACLES["scan_csv"] = PART_CSV
ORACLES["scan_csv_multiline"] = """
SELECT l_orderkey, l_linenumber, l_partkey, concat('say "', l_returnflag, '",', chr(10), l_linestatus, ', then', chr(13), chr(10), l_linestatus) AS note,
       CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem"""
ORACLES["skip_header"] = PART_CSV
ORACLES["parse_delimited"] = f"SELECT userId, movieId, rating, key FROM {RATINGS} r"
ORACLES["parse_ragged"] = ORACLES["baskets"]
ORACLES["row_index"] = ("SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS idx "
                        "FROM part")
ORACLES["inline_table"] = """
WITH req AS (SELECT * FROM (VALUES (100, 0.8), (35, 0.5), (60, 0.7)) v(n, s)),
req2 AS (SELECT CAST(n AS BIGINT) AS n, CAST(s AS DOUBLE) AS s FROM req),
sz AS (SELECT CAST(p_size AS BIGINT) AS n, count(*) AS parts FROM part GROUP BY p_size),
bb AS (SELECT r.n, r.s, sz.parts, (SELECT max(b) FROM range(1, r.n + 1) t(b)
        WHERE CAST(b AS DOUBLE) * ln(CAST(b AS DOUBLE)) <= -CAST(r.n AS DOUBLE) * ln(r.s)) AS b
       FROM req2 r LEFT JOIN sz USING (n))
SELECT n, parts, b, n // b AS r, (n // b) * b AS n_real,
       round(pow(1.0::DOUBLE / b, 1.0::DOUBLE / (n // b)), 9) AS s_real FROM bb"""
ORACLES["to_csv_lines"] = (
    f"SELECT park || ',' || CAST(count(*) AS VARCHAR) AS line FROM {TREES} t WHERE {PRESENT} GROUP BY park")
ORACLES["to_lines"] = ORACLES["distinct_sorted"]
ORACLES["to_map"] = "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand"
ORACLES["data_frame"] = f"""
WITH bi AS {_bi('p_brand')},
b AS (SELECT basket, list_sort(list(item)) AS items FROM bi GROUP BY basket),
l AS (SELECT CAST(basket AS VARCHAR) || ',' || array_to_string(items, ',') AS line,
             CAST(basket AS VARCHAR) AS plant, items FROM b)
SELECT row_number() OVER (ORDER BY line) - 1 AS id, plant, {pylist('items')} AS items FROM l"""
