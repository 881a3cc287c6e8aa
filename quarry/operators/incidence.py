"""Binary incidence of entities over features, kept in long (sparse) form.

``incidence(entity, feature)`` holds one row per present pair; an absent pair
is a missing row, so the cost follows the number of present pairs, not
entities x features. Distances pack an entity's features into bits, page by
page, and only pages that hold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.indexing import row_index
from quarry.session import bounded_side, written_table

def from_baskets(baskets: DataFrame, key: str, items: str,
                 entity: str = "entity", feature: str = "feature") -> DataFrame:
    """Turn ``(key, items[])`` baskets into ``(entity=item, feature=key)`` rows.

    Only the items are tested, never the basket's own key (a feature named
    like an entity does not make the entity present).
    """
    return (baskets.select(F.col(key).alias(feature), F.explode(items).alias(entity))
            .select(entity, feature).distinct())


def sizes(inc: DataFrame, name: str = "nx") -> DataFrame:
    """``(entity, nx)``: number of features of each entity (= its squared norm)."""
    return inc.groupBy("entity").agg(F.count(F.lit(1)).alias(name))


def lookup(inc: DataFrame, asked: DataFrame) -> DataFrame:
    """``(entity, feature, present)`` for each asked pair (left join, no explode)."""
    marks = inc.select("entity", "feature", F.lit(True).alias("__hit"))
    return (asked.select("entity", "feature")
            .join(marks, ["entity", "feature"], "left")
            .select("entity", "feature", F.coalesce("__hit", F.lit(False)).alias("present")))


WORD, PAGE = 64, 64   # features of a word; words of a page


def bitmaps(inc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(entity, page, words)`` and ``(entity, nx)``: features as bits, ``WORD * PAGE`` of them a row.

    Features get dense numbers by a distributed rank; pages without a feature
    of the entity have no row. Repeated pairs count once. Bits are aggregated
    in each task before the shuffle, so a feature that every entity has is one
    bit of a word like any other."""
    index, total = row_index(inc.select("feature").distinct(), ["feature"], with_total=True)
    at = F.col("idx")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(WORD)).cast("int"))
    word = F.pmod(F.floor(at / WORD), F.lit(PAGE))
    placed = inc.join(bounded_side(index, total), "feature").select(
        "entity", F.floor(at / (WORD * PAGE)).alias("page"), word.alias("word"), bit.alias("bit"))
    words = placed.groupBy("entity", "page", "word").agg(F.bit_or("bit").alias("bits"))
    held = words.groupBy("entity", "page").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))   # PAGE entries at most
    filled = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(PAGE - 1).cast("long")), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long")))
    pages = written_table(held.select("entity", "page", filled.alias("words")), "feature-bits")
    ones = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    return pages, pages.groupBy("entity").agg(F.sum(ones).alias("nx"))


def sq_distance(inc: DataFrame, pairs: DataFrame) -> DataFrame:
    """Squared Euclidean distance of asked entity pairs: ``|A| + |B| - 2|A n B|``.

    Driven by the asked pairs: each meets the pages of its first entity and
    then, by ``(entity, page)``, those of its second; a word of both is one AND
    and one bit count. The work of a pair follows its pages, not the features
    that it shares, and no pair is generated that was not asked for.
    ``inc`` is read twice; pass a materialized table when it is costly.
    """
    p = pairs.select(F.col("entity1"), F.col("entity2")).distinct()
    pages, n = bitmaps(inc)
    a = pages.select(F.col("entity").alias("entity1"), "page", F.col("words").alias("w1"))
    b = pages.select(F.col("entity").alias("entity2"), "page", F.col("words").alias("w2"))
    both = F.aggregate(F.zip_with("w1", "w2", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0).cast("long"), lambda s, x: s + x)
    inter = p.join(a, "entity1").join(b, ["entity2", "page"]).groupBy("entity1", "entity2").agg(F.sum(both).alias("inter"))
    n = written_table(n, "feature-counts")
    n1 = n.select(F.col("entity").alias("entity1"), F.col("nx").alias("n1"))
    n2 = n.select(F.col("entity").alias("entity2"), F.col("nx").alias("n2"))
    return (p.join(inter, ["entity1", "entity2"], "left")
            .join(n1, "entity1", "left").join(n2, "entity2", "left")
            .select("entity1", "entity2",
                    (F.coalesce("n1", F.lit(0)) + F.coalesce("n2", F.lit(0))
                     - 2 * F.coalesce("inter", F.lit(0))).cast("long").alias("distance")))
