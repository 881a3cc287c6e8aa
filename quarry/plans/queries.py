"""``queries()`` of the driver contract: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole tables of ``sf_dir`` (or data Spark derives from
them). Column names equal those of the matching SQL in ``oracles.py``;
doubles are rounded on both sides, arrays are rendered as Python prints them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import py_list_str, rounded
from quarry.operators import baskets as bk
from quarry.operators import cluster as cl
from quarry.operators import incidence as ic
from quarry.operators import lsh
from quarry.operators import recommend as rec
from quarry.operators import relational as rel
from quarry.operators.indexing import row_index
from quarry.plans import bindings as b
from quarry.session import bounded_side, fresh_path, release_unused, scratch_dir, written_table
from quarry.sinks import lines as sk
from quarry.sources import files as src
from quarry.sources.tables import Tables

# fixed values: parameters of the original exercises' own tests, kept as-is
# (seed 123 lives in bindings.SEED; ALS parameters in recommend.ALS_DEFAULTS)
N_PRIMES = 50                          # fifty consecutive primes
N_FAMILY = 10                          # ten hash functions in the family
N_BANDS, N_ROWS = 5, 7                 # LSH: five bands of seven rows
BAND_N, BAND_B, BAND_R = 12, 2, 2      # one band hash: n=12, band 2, two rows
K = 3                                  # k of the first k-means pass

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# --------------------------------------------------------------------------
# Relational core (tree census re-expressed on line items and parts)
# --------------------------------------------------------------------------

@query
def q_count_rows(spark, sf):
    return rel.count_rows(b.trees_weighted(Tables(spark, sf)), weight="n")


@query
def q_count_present(spark, sf):
    return rel.count_present(b.trees_weighted(Tables(spark, sf)), "park", weight="n")


@query
def q_distinct_sorted(spark, sf):
    return rel.distinct_sorted(b.trees_weighted(Tables(spark, sf)), "park")


@query
def q_group_count(spark, sf):
    return rel.group_count(b.trees_weighted(Tables(spark, sf)), "park", weight="n")


@query
def q_top_k_groups(spark, sf):
    return rel.top_k_groups(b.trees_weighted(Tables(spark, sf)), "park", k=10, weight="n")


def _year(y):
    return b.year_range("o_orderdate", y)


@query
def q_intersect_sorted(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderdate")
    a = o.where(_year(1995)).select(F.col("o_custkey").cast("string").alias("o_custkey"))
    c = o.where(_year(2001)).select(F.col("o_custkey").cast("string").alias("o_custkey"))
    return rel.intersect_sorted(a, c, "o_custkey")


@query
def q_union_all(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_quantity", "l_discount")
    a = li.where(F.col("l_quantity") < 25)
    c = li.where(F.col("l_discount") < 0.05)
    return rel.union_all(a, c).select("l_orderkey", "l_linenumber", "l_partkey")


@query
def q_distinct(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_custkey", F.year("o_orderdate").alias("o_year")).distinct()


@query
def q_rows_head(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return rel.rows_head(o, 20, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query
def q_filter_in(spark, sf):
    t = Tables(spark, sf)
    small = t.part.where(F.col("p_size") < 5).select("p_partkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return rel.filter_in(li, "l_partkey", small)


@query
def q_filter_range(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return rel.filter_range(o, "o_totalprice", 1000.0, 50000.0).select("o_orderkey")


@query
def q_filter_equal(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_brand", "p_name")
    return rel.filter_equal(p, "p_brand", "Brand#13").select("p_partkey", "p_name")


# --------------------------------------------------------------------------
# Recommenders (ratings re-expressed as customer x part x quantity)
# --------------------------------------------------------------------------


def _flagged(spark, sf):
    """Ratings with the split flag, joined and split ONCE and kept as a table
    in the shared folder; every later step (means, joins, RMSE) reads it."""
    scratch_dir(spark)
    return written_table(rec.split_by_key(b.ratings(Tables(spark, sf)), "key", b.SEED), "ratings")


def _split(spark, sf):
    f = _flagged(spark, sf)
    return f.where("is_train").drop("is_train"), f.where(~F.col("is_train")).drop("is_train")


@query
def q_split_by_key(spark, sf):
    r = b.ratings(Tables(spark, sf))
    return rec.split_by_key(r, "key", b.SEED).select("key", "is_train")


@query
def q_global_avg(spark, sf):
    train, _ = _split(spark, sf)
    return rec.global_avg(train).select(rounded("global_mean").alias("global_mean"))


@query
def q_group_avg(spark, sf):
    train, _ = _split(spark, sf)
    return rec.group_avg(train, "userId", name="user_mean").select(
        "userId", rounded("user_mean").alias("user_mean"))


@query
def q_global_mean_rmse(spark, sf):
    train, test = _split(spark, sf)
    return rec.global_mean_rmse(train, test).select(rounded("rmse").alias("rmse"))


@query
def q_means_and_interaction(spark, sf):
    train, _ = _split(spark, sf)
    mi = rec.means_and_interaction(train)
    return (mi.orderBy("userId", "movieId", "key").limit(50)
            .select("userId", "movieId", "rating",
                    rounded("user_mean").alias("user_mean"),
                    rounded("item_mean").alias("item_mean"),
                    rounded("user_item_interaction").alias("user_item_interaction")))


@query
def q_means_and_interaction_batches(spark, sf):
    """The whole training part, its means carried on over three batches of ratings."""
    train, _ = _split(spark, sf)
    batch = F.pmod(F.xxhash64("key"), F.lit(3))
    kept = written_table(rec.rating_sums(train.where(batch == 0)), "rating-sums")
    for k in (1, 2):
        kept = written_table(rec.merge_sums(kept, rec.rating_sums(train.where(batch == k))), "rating-sums")
    mi = rec.means_and_interaction(train, known=rec.means_of(kept))
    return mi.select("key", "userId", "movieId", "rating", rounded("user_mean").alias("user_mean"),
                     rounded("item_mean").alias("item_mean"), rounded("user_item_interaction").alias("user_item_interaction"))


@query
def q_bias_predict(spark, sf):
    train, test = _split(spark, sf)
    p = rec.bias_predict(train, test)
    return p.select("key", "userId", "movieId", "rating", rounded("prediction").alias("prediction"))


@query
def q_rmse(spark, sf):
    train, test = _split(spark, sf)
    return rec.rmse(rec.bias_predict(train, test)).select(rounded("rmse").alias("rmse"))


def _pair_split(spark, sf):
    """ALS input: mean rating per (user, item), split by the pair key."""
    r = b.ratings(Tables(spark, sf))
    pairs = (r.groupBy("userId", "movieId").agg(F.avg("rating").alias("rating"))
             .withColumn("pair", F.concat_ws(":", "userId", "movieId")))
    scratch_dir(spark)
    f = written_table(rec.split_by_key(pairs, "pair", b.SEED).drop("pair"), "rating-pairs")
    release_unused(spark)
    return f.where("is_train").drop("is_train"), f.where(~F.col("is_train")).drop("is_train")


@query
def q_als_rmse(spark, sf):
    train, test = _pair_split(spark, sf)
    return rec.als_rmse(train, test, b.SEED, counted=True).select(F.round("rmse", 4).alias("rmse"), "n_predicted")


@query
def q_als_bias_rmse(spark, sf):
    train, test = _pair_split(spark, sf)
    return rec.als_bias_rmse(train, test, b.SEED, counted=True).select(F.round("rmse", 4).alias("rmse"), "n_predicted")


#: SQL writes out the whole fit at this rank, so every predicted value is compared; als_rmse scores the full rank
PREDICT_RANK = 1


@query
def q_predict_ratings(spark, sf):
    train, test = _pair_split(spark, sf)
    model = rec.als_fit(train, b.SEED, rank=PREDICT_RANK)
    return rec.predict_ratings(model, test).select("userId", "movieId", rounded("rating").alias("rating"),
                                                   F.round(F.col("prediction").cast("double"), 6).alias("prediction"))


# --------------------------------------------------------------------------
# Market baskets: orders as baskets, part brands (25) or part types (6) as items
# --------------------------------------------------------------------------


BRAND_SUPPORT = 0.02
TYPE_SUPPORT, TYPE_CONFIDENCE = 0.05, 0.3


def _baskets(spark, sf, item_col):
    return bk.baskets(b.order_items(Tables(spark, sf), item_col))


@query
def q_baskets(spark, sf):
    return _baskets(spark, sf, "p_brand").select("basket", py_list_str("items").alias("items"))


@query
def q_frequent_itemsets(spark, sf):
    model = bk.fit(_baskets(spark, sf, "p_brand"), BRAND_SUPPORT, 0.5)
    fi = bk.frequent_itemsets(model)
    return fi.select(py_list_str("items").alias("items"), "freq")


@query
def q_frequent_itemsets_types(spark, sf):
    model = bk.fit(_baskets(spark, sf, "p_type"), TYPE_SUPPORT, TYPE_CONFIDENCE)
    fi = bk.frequent_itemsets(model)
    return fi.select(py_list_str("items").alias("items"), "freq")


@query
def q_association_rules(spark, sf):
    model = bk.fit(_baskets(spark, sf, "p_type"), TYPE_SUPPORT, TYPE_CONFIDENCE)
    r = bk.association_rules(model)
    return r.select(py_list_str("antecedent").alias("antecedent"),
                    py_list_str("consequent").alias("consequent"),
                    rounded("confidence").alias("confidence"))


@query
def q_rule_interest(spark, sf):
    model = bk.fit(_baskets(spark, sf, "p_type"), TYPE_SUPPORT, TYPE_CONFIDENCE)
    r = bk.rule_interest(model)
    return r.select(py_list_str("antecedent").alias("antecedent"),
                    py_list_str("consequent").alias("consequent"),
                    rounded("confidence").alias("confidence"),
                    py_list_str("items").alias("items"), "freq",
                    rounded("interest").alias("interest"))


# --------------------------------------------------------------------------
# Clustering: nations (entities) over the parts their customers bought
# --------------------------------------------------------------------------


K_CUST = 5


def _written_incidence(spark, sf, fn=None):
    """The incidence, computed once and kept in the shared folder: the
    clustering operators act on it several times."""
    scratch_dir(spark)
    return (fn or b.nation_parts)(Tables(spark, sf)).checkpoint()


@query
def q_incidence_lookup(spark, sf):
    t = Tables(spark, sf)
    return ic.lookup(b.nation_parts(t), b.supplier_nation_parts(t))


@query
def q_sq_distance(spark, sf):
    # the incidence is read three times (pairs, probes, sizes): write it once
    t = Tables(spark, sf)
    return ic.sq_distance(_written_incidence(spark, sf), b.trade_nation_pairs(t))


@query
def q_init_centroids(spark, sf):
    return cl.init_centroids(b.nation_parts(Tables(spark, sf)), K, b.SEED)


@query
def q_kmeans_first_iter(spark, sf):
    inc = _written_incidence(spark, sf)
    return cl.first_iter(inc, cl.init_centroids(inc, K, b.SEED))


@query
def q_kmeans_update(spark, sf):
    inc = _written_incidence(spark, sf)
    start = cl.init_centroids(inc, K, b.SEED)
    cnt, meta = cl.initial_state(inc, start)
    a = cl.assign(inc, ic.sizes(inc), cnt, meta, K)
    cnt1, meta1 = cl.update(inc, a, cnt, meta)
    w = cl.weights(cnt1, meta1)
    return w.select("cluster", "feature", rounded("weight").alias("weight"))


@query
def q_kmeans(spark, sf):
    inc = _written_incidence(spark, sf)
    return cl.classes(cl.kmeans(inc, cl.init_centroids(inc, K, b.SEED), written=True).assignment)


@query
def q_kmeans_customers(spark, sf):
    inc = _written_incidence(spark, sf, b.customer_brands)
    return cl.classes(cl.kmeans(inc, cl.init_centroids(inc, K_CUST, b.SEED), written=True).assignment)


# --------------------------------------------------------------------------
# Primes, hashing, min-hash and LSH: nations over parts, documents over shingles
# --------------------------------------------------------------------------




@query
def q_prime_keys(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    return lsh.primes_in(o, "o_orderkey")


@query
def q_next_primes(spark, sf):
    m = Tables(spark, sf).part.count()
    return lsh.next_primes(spark, N_PRIMES, m)


@query
def q_primes_from(spark, sf):
    """The three primes that follow each order's price in whole units."""
    o = Tables(spark, sf).orders.select(F.floor("o_totalprice").alias("price"))
    return lsh.primes_from(o, "price", 3)


def _part_family(spark, sf, n):
    m = Tables(spark, sf).part.count()
    return lsh.hash_family(spark, b.SEED, n, m), m


@query
def q_hash_column(spark, sf):
    (fam, m) = _part_family(spark, sf, 1)
    _, a, bb, p = fam[0]
    part = Tables(spark, sf).part.select("p_partkey")
    return lsh.hash_column(part, "p_partkey", a, bb, p, "h", x_max=part.agg(F.max("p_partkey")).first()[0])


@query
def q_hash_family_apply(spark, sf):
    fam, _ = _part_family(spark, sf, N_FAMILY)
    part = Tables(spark, sf).part.select("p_partkey")
    return lsh.hash_family_apply(part, "p_partkey", fam, x_max=part.agg(F.max("p_partkey")).first()[0])


def _nation_sig(spark, sf, n):
    t = Tables(spark, sf)
    fam, m = _part_family(spark, sf, n)
    idx, n_idx = row_index(t.part.select(F.col("p_partkey").alias("feature")), ["feature"], with_total=True)
    inc = b.nation_parts(t).join(bounded_side(idx, n_idx), "feature")
    return lsh.signatures_wide(inc, fam, x_max=m - 1)


@query
def q_minhash_signatures(spark, sf):
    return lsh.signatures_long(_nation_sig(spark, sf, N_BANDS * N_ROWS))


@query
def q_band_hash(spark, sf):
    return lsh.band_hash(_nation_sig(spark, sf, BAND_N), BAND_B, BAND_R)


@query
def q_lsh_buckets(spark, sf):
    bands = lsh.band_hashes(_nation_sig(spark, sf, N_BANDS * N_ROWS), N_BANDS, N_ROWS)
    return lsh.lsh_buckets(bands)


@query
def q_lsh_band_plan(spark, sf):
    """Requests of the line items: part key + 1 as number of hash functions, discount below 1 as threshold."""
    req = Tables(spark, sf).lineitem.select((F.col("l_partkey").cast("long") + 1).alias("n"), (F.lit(1.0) - F.col("l_discount")).alias("s")).distinct()
    out = lsh.band_plan(req)
    return out.select("n", rounded("s", 9).alias("s"), "b", "r", "n_real",
                      rounded("s_real", 9).alias("s_real"))


DOC_SHINGLE = 3
DOC_BANDS, DOC_ROWS = 10, 4


@query
def q_doc_lsh_buckets(spark, sf):
    from quarry.operators import text

    docs = Tables(spark, sf).documents.select(F.col("doc_id").alias("entity"), "text")
    # the test table is one row group, which one task reads: deal it out before the words are split
    docs = docs.repartition(spark.sparkContext.defaultParallelism) if len(docs.inputFiles()) == 1 else docs
    inc = text.shingle_occurrences(docs, DOC_SHINGLE)
    _, _, buckets = lsh.minhash_lsh(inc, ["feature"], b.SEED, DOC_BANDS, DOC_ROWS, materialize=False)
    return buckets


# --------------------------------------------------------------------------
# Sources and sinks: whole tables written below the shared scratch folder,
# read back with the operator under test, compared with SQL on the parquet
# --------------------------------------------------------------------------


NULL_MARK = "\\N"
PART_CSV_SCHEMA = "p_partkey LONG, label STRING, park STRING, p_size INT, p_retailprice DOUBLE"


def _part_csv_frame(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", F.concat_ws(", ", "p_name", "p_brand").alias("label"),
                    b.park_expr().alias("park"), "p_size", "p_retailprice")


@query
def q_scan_csv(spark, sf):
    path = fresh_path(spark, "part-csv")
    sk.write_csv(_part_csv_frame(spark, sf), path, header=True, null_value=NULL_MARK)
    return src.scan_csv(spark, path, PART_CSV_SCHEMA, header=True, null_value=NULL_MARK)


ITEMS_A_FILE = 4_000_000
ITEM_CSV_SCHEMA = "l_orderkey LONG, l_linenumber INT, l_partkey LONG, note STRING, l_quantity DOUBLE"


@query
def q_scan_csv_multiline(spark, sf):
    """Files of all line items, their notes on two lines, with malformed records among them.

    A file has up to about ``ITEMS_A_FILE`` line items: large enough to be read by
    many tasks, and no task writes more however many line items there are."""
    li = Tables(spark, sf).lineitem
    note = F.concat(F.lit('say "'), "l_returnflag", F.lit('",\n'), "l_linestatus", F.lit(", then\r\n"), "l_linestatus")
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    good = F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey", quoted, F.col("l_quantity").cast("string"))
    bad = F.when(F.col("l_partkey") % 20 == 0, F.concat_ws(",", "l_orderkey", F.lit('no"number'), "l_partkey", quoted, F.lit("1.0"))).when(
        F.col("l_partkey") % 20 == 1, F.concat_ws(",", "l_orderkey", quoted)).when(F.col("l_partkey") % 20 == 2, F.lit("1,2,3,4,5,6,7"))
    path = fresh_path(spark, "items-csv")
    lines = li.select(F.concat_ws("\n", good, bad).alias("value"))
    n = max(1, -(-li.count() // ITEMS_A_FILE))
    sk.write_lines(sk.headed(lines.coalesce(n), "l_orderkey,l_linenumber,l_partkey,note,l_quantity"), path)
    return src.scan_csv(spark, path, ITEM_CSV_SCHEMA, header=True, multiline=True)


@query
def q_skip_header(spark, sf):
    path = fresh_path(spark, "part-csv-text")
    sk.write_csv(_part_csv_frame(spark, sf), path, header=True, null_value=NULL_MARK)
    body = src.skip_header(src.scan_text(spark, path))
    return src.parse_csv_line(body, PART_CSV_SCHEMA, null_value=NULL_MARK)


@query
def q_parse_delimited(spark, sf):
    r = b.ratings(Tables(spark, sf))
    path = fresh_path(spark, "ratings-text")
    sk.write_lines(r.select(F.concat_ws("::", "userId", "movieId", "rating", "key").alias("value")), path)
    return src.parse_delimited(src.scan_text(spark, path), ["userId", "movieId", "rating", "key"],
                               ["long", "long", "double", "string"])


@query
def q_parse_ragged(spark, sf):
    bs = _baskets(spark, sf, "p_brand")
    path = fresh_path(spark, "baskets-text")
    sk.write_lines(bs.select(F.concat_ws(",", F.col("basket").cast("string"),
                                         F.array_join("items", ",")).alias("value")), path)
    parsed = src.parse_ragged(src.scan_text(spark, path), key="basket")
    return parsed.select(F.col("basket").cast("long").alias("basket"), py_list_str("items").alias("items"))


@query
def q_row_index(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name")
    return row_index(p, ["p_name", "p_partkey"], "idx")


@query
def q_inline_table(spark, sf):
    # the (n, s) requests of the band plan, given inline, joined to the data
    req = src.inline_table(spark, [(100, 0.8), (35, 0.5), (60, 0.7)], "n LONG, s DOUBLE")
    sizes = Tables(spark, sf).part.groupBy(F.col("p_size").cast("long").alias("n")).agg(
        F.count(F.lit(1)).alias("parts"))
    return lsh.band_plan(req.join(sizes, "n", "left")).select(
        "n", "parts", "b", "r", "n_real", rounded("s_real", 9).alias("s_real"))


@query
def q_to_csv_lines(spark, sf):
    g = rel.group_count(b.trees_weighted(Tables(spark, sf)), "park", weight="n")
    return sk.to_csv_lines(g)


@query
def q_to_lines(spark, sf):
    d = rel.distinct_sorted(b.trees_weighted(Tables(spark, sf)), "park")
    path = fresh_path(spark, "parks-lines")
    sk.write_sorted_lines(d, "park", path)
    return src.scan_text(spark, path).select(F.col("value").alias("park"))


@query
def q_to_map(spark, sf):
    p = Tables(spark, sf).part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))
    return sk.to_map(p, "p_brand", "parts")


# k-means second use: real-valued embedding vectors in long form (entity, dimension, value)
K_EMB = 10


def _embedding_values(spark, sf):
    scratch_dir(spark)
    e = Tables(spark, sf).embeddings.select("vec_id", "embedding")
    return (e.select(F.col("vec_id").alias("entity"), F.posexplode("embedding").alias("feature", "value"))
            .select("entity", "feature", F.col("value").cast("double").alias("value"))
            .checkpoint())


@query
def q_kmeans_embeddings_first_iter(spark, sf):
    inc = _embedding_values(spark, sf)
    return cl.first_iter(inc, cl.init_centroids(inc, K_EMB, b.SEED), value="value")


@query
def q_kmeans_embeddings(spark, sf):
    inc = _embedding_values(spark, sf)
    return cl.classes(cl.kmeans(inc, cl.init_centroids(inc, K_EMB, b.SEED), value="value", written=True).assignment)


@query
def q_data_frame(spark, sf):
    """Baskets as a ragged text file (written sorted, in several part files),
    read back as ``(id = line number - 1, plant = key, items = rest)``."""
    bs = _baskets(spark, sf, "p_brand")
    lines = bs.select(F.concat_ws(",", F.col("basket").cast("string"), F.array_join("items", ",")).alias("value"))
    path = fresh_path(spark, "plants-text")
    sk.write_sorted_lines(lines, "value", path)
    indexed = src.file_row_index(src.scan_text(spark, path), "id")
    parsed = src.parse_ragged(indexed.select("id", "value"), key="plant")
    return parsed.select("id", "plant", py_list_str("items").alias("items"))
