"""Shared derived inputs of the query bindings.

The original exercises' inputs (a tree census CSV, a ratings file, a plant/state
file) are not part of the test data, so each is re-expressed on the shared
TPC-H-like tables with the same shape:

* trees    -> line items joined to their part; the "park" of a tree is the
              part name, missing (null) for ``Brand#1`` and empty (``''``) for
              ``Brand#2`` so that both spellings of "absent" occur;
* ratings  -> user = ``o_custkey``, item = ``l_partkey``,
              rating = ``l_quantity``, row key = orderkey:linenumber:partkey;
* baskets  -> one basket per order holding the distinct brands (or types)
              of its parts;
* incidence-> entity = nation name of the buying customer, feature = part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.tables import Tables

# fixed value: the seed of the original exercises
SEED = 123


def park_expr() -> Column:
    return (F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("string"))
            .when(F.col("p_brand") == "Brand#2", F.lit(""))
            .otherwise(F.col("p_name")))


def trees_weighted(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """``(park, n)``: line items per part, pre-aggregated, then joined to part.

    Counting per ``l_partkey`` first shrinks the fact side to at most one row
    per part per map task before any exchange, so the join shuffles part-sized
    data instead of line-item-sized data, and a hot part cannot skew it.
    """
    li = lineitem if lineitem is not None else t.lineitem
    per_part = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    part = t.part.select("p_partkey", park_expr().alias("park"))
    return per_part.join(part, per_part.l_partkey == part.p_partkey).select("park", "n")


def ratings(t: Tables) -> DataFrame:
    """``(key, userId, movieId, rating)`` from line items and their orders."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("key"),
                    F.col("o_custkey").alias("userId"),
                    F.col("l_partkey").alias("movieId"),
                    F.col("l_quantity").cast("double").alias("rating")))


def year_range(col: str, year: int) -> Column:
    """``year(col) = year`` as a range, so parquet can skip row groups."""
    return (F.col(col) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & \
           (F.col(col) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))


def order_items(t: Tables, item_col: str) -> DataFrame:
    """``(order, item)`` rows: the ``item_col`` of each part of each order."""
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", F.col(item_col).alias("item"))
    return li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("basket"), "item")


def nation_parts(t: Tables) -> DataFrame:
    """Distinct ``(entity, feature)``: nation name of the buyer, part key.

    Orders meet customers first (order-sized join), so the one line-item
    sized join yields ``(nation, part)`` rows that a partial aggregate
    de-duplicates before they are shuffled.
    """
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    on = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
          .select("o_orderkey", "n_name"))
    li = t.lineitem.select("l_orderkey", "l_partkey")
    return (li.join(on, li.l_orderkey == on.o_orderkey)
            .select(F.col("n_name").alias("entity"), F.col("l_partkey").cast("long").alias("feature"))
            .distinct())


def supplier_nation_parts(t: Tables) -> DataFrame:
    """Distinct ``(entity, feature)`` asked pairs: supplier nation, part supplied."""
    li = t.lineitem.select("l_suppkey", "l_partkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    return (li.join(s, li.l_suppkey == s.s_suppkey).select("s_nationkey", "l_partkey").distinct()
            .join(n, F.col("s_nationkey") == n.n_nationkey)
            .select(F.col("n_name").alias("entity"), F.col("l_partkey").cast("long").alias("feature")))


def trade_nation_pairs(t: Tables) -> DataFrame:
    """Distinct ``(entity1, entity2)``: supplier nation < customer nation of a line item."""
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    pairs = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
             .join(s, F.col("l_suppkey") == s.s_suppkey)
             .select("s_nationkey", "c_nationkey").distinct())
    n1 = t.nation.select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("entity1"))
    n2 = t.nation.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("entity2"))
    return (pairs.join(n1, pairs.s_nationkey == n1.k1).join(n2, pairs.c_nationkey == n2.k2)
            .where(F.col("entity1") < F.col("entity2")).select("entity1", "entity2"))


def customer_brands(t: Tables) -> DataFrame:
    """Distinct ``(entity, feature)``: customer key (as text), brand bought."""
    li = t.lineitem.select("l_orderkey", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    p = t.part.select("p_partkey", "p_brand")
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, F.col("l_partkey") == p.p_partkey)
            .select(F.col("o_custkey").cast("string").alias("entity"),
                    F.col("p_brand").alias("feature")).distinct())
