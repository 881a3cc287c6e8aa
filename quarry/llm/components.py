"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(vertex, component)`` for every vertex with a link to another one;
    ``component`` is the smallest vertex that links lead to.

    Large-star and small-star rounds over (larger, smaller) edges. Every round
    is one aggregate and one join per star, written to the shared folder; the
    minima are written before they are joined back, so a star with very many
    points is an ordinary skewed join that adaptive execution splits.
    """
    scratch = Scratch(links.sparkSession)
    edges = scratch.write(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = scratch.write(  # every larger neighbour of u links to the smallest around u
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        least2 = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = scratch.write(
            large.join(least2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least2.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        new = _state(small)
        scratch.drop(edges, least, large, least2)
        edges, done, state = small, new == state, new
        if done:
            break
    # stable: every edge leads from a vertex to the smallest of its component
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("component"))).distinct()
