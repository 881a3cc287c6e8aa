"""Market-basket mining: baskets, frequent itemsets, rules, interest.

Mining itself is MLlib's parallel FP-Growth (PFP): items are hashed to
groups, each group's conditional transactions are shuffled to one task, and
the trees are mined independently. The basket arrays are built with
``collect_set``, whose partial aggregation de-duplicates items map-side, so a
basket's array is bounded by the item vocabulary, not by its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def baskets(rows: DataFrame, basket: str = "basket", item: str = "item",
            items: str = "items") -> DataFrame:
    """``(basket, items)``: sorted distinct items of each basket."""
    return (rows.where(F.col(item).isNotNull())
            .groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias(items)))


def fit(basket_df: DataFrame, min_support: float, min_confidence: float,
        items: str = "items", num_partitions: int | None = None):
    from pyspark.ml.fpm import FPGrowth

    fp = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(basket_df.select(items))
    # itemsets feed both the itemset output and the rules (and the interest
    # join): keep them so the tree mining runs once (spills to disk if large)
    model.freqItemsets.persist()
    return model


def _key(c: str) -> Column:
    return F.array_join(F.col(c), ",")


def frequent_itemsets(model, n: int | None = None) -> DataFrame:
    """``(items, freq, size)`` by size desc, freq desc, items asc; first ``n``.

    FP-Growth keeps an itemset when ``freq >= ceil(minSupport * baskets)``.
    """
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq",
                                   F.size("items").alias("size"))
    fi = fi.orderBy(F.desc("size"), F.desc("freq"), _key("items"))
    return fi.limit(n) if n else fi


def association_rules(model, n: int | None = None) -> DataFrame:
    """``(antecedent, consequent, confidence)``, by antecedent size desc, confidence desc."""
    r = model.associationRules.select(F.array_sort("antecedent").alias("antecedent"),
                                      F.array_sort("consequent").alias("consequent"),
                                      "confidence")
    r = r.orderBy(F.desc(F.size("antecedent")), F.desc("confidence"),
                  _key("antecedent"), _key("consequent"))
    return r.limit(n) if n else r


def rule_interest(model, n: int | None = None) -> DataFrame:
    """Rules with ``interest = |confidence - freq(consequent) / baskets|``.

    The share of baskets with the consequent is ``confidence / lift``, so the
    baskets need not be counted again. The consequent's frequency comes from
    joining the size-one itemsets (at most one row per item) on the consequent
    array.
    """
    rules = model.associationRules.select(F.array_sort("antecedent").alias("antecedent"),
                                          F.array_sort("consequent").alias("consequent"),
                                          "confidence", "lift")
    singles = (model.freqItemsets.where(F.size("items") == 1)
               .select(F.col("items"), F.col("freq")))
    j = rules.join(singles, rules.consequent == singles["items"])
    j = j.withColumn("interest", F.abs(F.col("confidence") - F.col("confidence") / F.col("lift")))
    j = j.orderBy(F.desc(F.size("antecedent")), F.desc(F.round("interest", 12)),
                  _key("antecedent"), _key("consequent"))
    out = j.select("antecedent", "consequent", "confidence", "items", "freq", "interest")
    return out.limit(n) if n else out
