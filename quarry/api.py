"""File-level functions with the names and arguments of the original exercises.

Each function takes a SparkSession first, then the arguments the original
function took (file paths and parameters), and returns a DataFrame built
from the operators of this package. The originals returned strings or
collected rows; ``sinks.lines.to_csv_lines(df)`` gives the CSV-line form and
``df.collect()`` the rows, at the caller's choice.

Input formats:

* trees    header CSV with a ``Nom_parc`` column (quoted fields allowed);
* ratings  ``user::item::rating::timestamp`` lines;
* plants   ragged CSV lines ``plant,state,state,...`` (no header).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import baskets as bk
from quarry.operators import cluster as cl
from quarry.operators import incidence as ic
from quarry.operators import lsh
from quarry.operators import recommend as rec
from quarry.operators import relational as rel
from quarry.operators.indexing import row_index
from quarry.sinks.lines import to_csv_lines
from quarry.session import bounded_side
from quarry.sources import files as src

PARK = "Nom_parc"


# ----------------------------------------------------------------- trees
def _trees(spark: SparkSession, filename: str, multiline: bool = True) -> DataFrame:
    """All columns as strings, names from the header; records, not lines.

    ``multiline`` lets a quoted field span lines; False reads a file without
    such fields in one scan instead of two."""
    return src.scan_csv(spark, filename, None, header=True, multiline=multiline)


def count(spark: SparkSession, filename: str, multiline: bool = True) -> DataFrame:
    """``(n_rows)``: number of trees (data records)."""
    return rel.count_rows(_trees(spark, filename, multiline))


def parks(spark: SparkSession, filename: str, multiline: bool = True) -> DataFrame:
    """``(n_present)``: trees located in a park."""
    return rel.count_present(_trees(spark, filename, multiline), PARK)


def uniq_parks(spark: SparkSession, filename: str, multiline: bool = True) -> DataFrame:
    """``(Nom_parc)``: the parks, sorted."""
    return rel.distinct_sorted(_trees(spark, filename, multiline), PARK)


def uniq_parks_counts(spark: SparkSession, filename: str, multiline: bool = True) -> DataFrame:
    """``(line)``: ``park,count`` per park, sorted by park."""
    return to_csv_lines(rel.group_count(_trees(spark, filename, multiline), PARK))


def frequent_parks_count(spark: SparkSession, filename: str, k: int = 10, multiline: bool = True) -> DataFrame:
    """``(line)``: the ``k`` parks with most trees, ties by name."""
    return to_csv_lines(rel.top_k_groups(_trees(spark, filename, multiline), PARK, k))


def intersection(spark: SparkSession, filename1: str, filename2: str, multiline: bool = True) -> DataFrame:
    """``(Nom_parc)``: parks present in both files, sorted."""
    return rel.intersect_sorted(_trees(spark, filename1, multiline), _trees(spark, filename2, multiline), PARK)


# ----------------------------------------------------------------- ratings
def _ratings(spark: SparkSession, filename: str) -> DataFrame:
    lines = src.scan_text(spark, filename)
    return src.parse_delimited(lines, ["userId", "movieId", "rating"], ["long", "long", "double"])


def _split(ratings: DataFrame, seed: int, split: str):
    """``random``: the original ``randomSplit`` (depends on column order);
    ``key``: the md5 split on ``userId:movieId``, stable everywhere."""
    if split == "random":
        return rec.random_split(ratings, seed)
    keyed = ratings.withColumn("__key", F.concat_ws(":", "userId", "movieId"))
    tr, te = rec.train_test(keyed, "__key", seed)
    return tr.drop("__key"), te.drop("__key")


def basic_als_recommender(spark: SparkSession, filename: str, seed: int, split: str = "random") -> DataFrame:
    """``(rmse)`` of ALS (rank 70, 5 iterations, regParam 0.01, cold start drop)."""
    train, test = _split(_ratings(spark, filename), seed, split)
    return rec.als_rmse(train, test, seed)


def global_average(spark: SparkSession, filename: str, seed: int, split: str = "random") -> DataFrame:
    """``(global_mean)`` of the training ratings."""
    train, _ = _split(_ratings(spark, filename), seed, split)
    return rec.global_avg(train)


def global_average_recommender(spark: SparkSession, filename: str, seed: int,
                               split: str = "random") -> DataFrame:
    """``(rmse)`` of predicting every test rating by the training mean."""
    train, test = _split(_ratings(spark, filename), seed, split)
    return rec.global_mean_rmse(train, test)


def means_and_interaction(spark: SparkSession, filename: str, seed: int, n: int,
                          split: str = "random") -> DataFrame:
    """First ``n`` training rows by (userId, movieId) with user/item means and interaction."""
    train, _ = _split(_ratings(spark, filename), seed, split)
    mi = rec.means_and_interaction(train)
    return (mi.orderBy("userId", "movieId", "rating").limit(n)
            .select("userId", "movieId", "rating", "user_mean", "item_mean", "user_item_interaction"))


def als_with_bias_recommender(spark: SparkSession, filename: str, seed: int,
                              split: str = "random") -> DataFrame:
    """``(rmse)`` of ALS on the interaction plus user and item bias."""
    train, test = _split(_ratings(spark, filename), seed, split)
    return rec.als_bias_rmse(train, test, seed)


# ----------------------------------------------------------------- plants
def _plants(spark: SparkSession, filename: str) -> DataFrame:
    """``(id, plant, items)``: id = line number - 1, items in file order."""
    lines = src.file_row_index(src.scan_text(spark, filename), "id")
    return src.parse_ragged(lines.select("id", "value"), key="plant")


def _incidence(spark: SparkSession, filename: str) -> DataFrame:
    """``(entity=state, feature=plant)`` from the plant lines."""
    return ic.from_baskets(_plants(spark, filename), "plant", "items")


def data_frame(spark: SparkSession, filename: str, n: int) -> DataFrame:
    """First ``n`` baskets by id: ``(id, plant, items)``."""
    return _plants(spark, filename).orderBy("id").limit(n)


def _model(spark, filename, s, c):
    baskets = _plants(spark, filename).select(F.array_distinct("items").alias("items"))
    return bk.fit(baskets, s, c), baskets


def frequent_itemsets(spark: SparkSession, filename: str, n: int, s: float, c: float) -> DataFrame:
    """First ``n`` itemsets by size desc, frequency desc: ``(items, freq)``."""
    model, _ = _model(spark, filename, s, c)
    return bk.frequent_itemsets(model, n).select("items", "freq")


def association_rules(spark: SparkSession, filename: str, n: int, s: float, c: float) -> DataFrame:
    """First ``n`` rules by antecedent size desc, confidence desc."""
    model, _ = _model(spark, filename, s, c)
    return bk.association_rules(model, n)


def interests(spark: SparkSession, filename: str, n: int, s: float, c: float) -> DataFrame:
    """First ``n`` rules by antecedent size desc, interest desc."""
    model, _ = _model(spark, filename, s, c)
    return bk.rule_interest(model, n)


def data_preparation(spark: SparkSession, filename: str, plant: str, state: str) -> DataFrame:
    """``(entity, feature, present)``: does ``plant`` occur in ``state``."""
    asked = spark.createDataFrame([(state, plant)], "entity STRING, feature STRING")
    return ic.lookup(_incidence(spark, filename), asked)


def distance2(spark: SparkSession, filename: str, state1: str, state2: str) -> DataFrame:
    """``(entity1, entity2, distance)``: squared Euclidean distance of two states."""
    pairs = spark.createDataFrame([(state1, state2)], "entity1 STRING, entity2 STRING")
    return ic.sq_distance(_incidence(spark, filename), pairs)


def _chosen(k: int, seed: int, chosen: Sequence[str] | None,
            candidates: Sequence[str] | None) -> Sequence[str] | None:
    """Start entities: given ones, or Python's seeded ``random.sample`` of a
    caller's candidate list (k names on the driver), else None (md5 choice)."""
    if chosen is not None or candidates is None:
        return chosen
    import random

    return random.Random(seed).sample(list(candidates), k)


def init_centroids(spark: SparkSession, filename: str, k: int, seed: int,
                   chosen: Sequence[str] | None = None,
                   candidates: Sequence[str] | None = None) -> DataFrame:
    """``(cluster, entity)``: ``k`` start states.

    ``chosen`` names them; ``candidates`` is a list to draw ``k`` from with
    ``random.Random(seed).sample``; otherwise a seeded md5 choice.
    """
    return cl.init_centroids(_incidence(spark, filename), k, seed, _chosen(k, seed, chosen, candidates))


def first_iter(spark: SparkSession, filename: str, k: int, seed: int,
               chosen: Sequence[str] | None = None,
               candidates: Sequence[str] | None = None) -> DataFrame:
    """``(centroid, member)``: each state under its nearest start state."""
    inc = _incidence(spark, filename).checkpoint()
    return cl.first_iter(inc, cl.init_centroids(inc, k, seed, _chosen(k, seed, chosen, candidates)))


def kmeans(spark: SparkSession, filename: str, k: int, seed: int,
           chosen: Sequence[str] | None = None,
           candidates: Sequence[str] | None = None) -> DataFrame:
    """``(leader, member)``: the classes, each named by its smallest member."""
    inc = _incidence(spark, filename).checkpoint()
    start = cl.init_centroids(inc, k, seed, _chosen(k, seed, chosen, candidates))
    return cl.classes(cl.kmeans(inc, start, written=True).assignment)


# ----------------------------------------------------------------- min-hash / LSH
def primes(spark: SparkSession, n: int, c: int) -> DataFrame:
    """``(i, p)``: ``n`` consecutive primes from ``c``."""
    return lsh.next_primes(spark, n, c)


def hash_plants(spark: SparkSession, s: int, m: int, p: int, x: int) -> DataFrame:
    """``(h)``: ``(a*x+b) % p`` with ``a``, ``b`` drawn in ``1..m`` from seed ``s``."""
    a, b = lsh.draw_ab(s, 1, m)[0]
    return lsh.hash_column(spark.createDataFrame([(x,)], "x LONG"), "x", a, b, p).select("h")


def hash_list(spark: SparkSession, s: int, m: int, n: int, i: int, x: int) -> DataFrame:
    """``(h)``: the ``i``-th of ``n`` hash functions (primes from ``m``) applied to ``x``."""
    _, a, b, p = lsh.hash_family(spark, s, n, m)[i]
    return lsh.hash_column(spark.createDataFrame([(x,)], "x LONG"), "x", a, b, p).select("h")


def _signatures(spark: SparkSession, datafile: str, seed: int, n: int, states: Sequence[str] | None = None):
    """Wide signatures; feature index = rank of the plant (then line) among all lines.

    A plant's index belongs to its line: lines that repeat a name are features
    of their own, so states meet the index by line."""
    plants = _plants(spark, datafile).checkpoint()
    idx, m = row_index(plants.select("plant", "id"), ["plant", "id"], with_total=True)
    family = lsh.hash_family(spark, seed, n, m)
    inc = ic.from_baskets(plants, "id", "items")
    if states is not None:
        inc = inc.where(F.col("entity").isin(list(states)))
    inc_i = inc.join(bounded_side(idx.select(F.col("id").alias("feature"), "idx"), m), "feature")
    return lsh.signatures_wide(inc_i, family, x_max=max(m - 1, 0))


def signatures(spark: SparkSession, datafile: str, seed: int, n: int, state: str) -> DataFrame:
    """``(i, h)``: the min-hash signature of ``state``."""
    return lsh.signatures_long(_signatures(spark, datafile, seed, n, [state])).select("i", "h")


def hash_band(spark: SparkSession, datafile: str, seed: int, state: str, n: int, b: int,
              n_r: int) -> DataFrame:
    """``(bucket)``: hash of band ``b`` (``n_r`` rows) of the signature of ``state``."""
    return lsh.band_hash(_signatures(spark, datafile, seed, n, [state]), b, n_r).select("bucket")


def hash_bands(spark: SparkSession, data_file: str, seed: int, n_b: int, n_r: int) -> DataFrame:
    """``(band, bucket, member, size)``: buckets holding two or more states."""
    sig = _signatures(spark, data_file, seed, n_b * n_r)
    return lsh.lsh_buckets(lsh.band_hashes(sig, n_b, n_r))


def get_b_and_r(spark: SparkSession, n: int, s: float) -> DataFrame:
    """``(n, s, b, r, n_real, s_real)`` for ``n`` hash functions and threshold ``s``."""
    return lsh.band_plan(spark.createDataFrame([(n, s)], "n LONG, s DOUBLE"))


__all__ = [
    "count", "parks", "uniq_parks", "uniq_parks_counts", "frequent_parks_count", "intersection",
    "basic_als_recommender", "global_average", "global_average_recommender", "means_and_interaction", "als_with_bias_recommender", "data_frame",
    "frequent_itemsets", "association_rules", "interests", "data_preparation", "distance2", "init_centroids",
    "first_iter", "kmeans", "primes", "hash_plants", "hash_list", "signatures",
    "hash_band", "hash_bands", "get_b_and_r",
]
