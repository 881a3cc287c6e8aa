"""Text to features: whitespace words and word shingles, whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: the whitespace class used to cut words (same in Java regex and RE2)
WHITESPACE = "[ \\t\\n\\r\\f\\x0B]+"


def words(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(t, WHITESPACE), "")


def shingle_occurrences(docs: DataFrame, k: int, entity: str = "entity", text: str = "text") -> DataFrame:
    """``(entity, feature)`` for every shingle occurrence (repeats kept).

    Enough for min-hash, where a repeat cannot change a minimum, and saves
    the shuffle of a distinct.
    """
    w = docs.select(entity, words(text).alias("__w"))
    n = F.size("__w")
    zipped = F.arrays_zip(*[F.slice("__w", j + 1, F.greatest(n - k + 1, F.lit(1))) for j in range(k)])
    full = (w.where(n >= k).select(entity, F.explode(zipped).alias("__s"))
            .select(entity, F.concat_ws(" ", *[F.col(f"__s.{j}") for j in range(k)]).alias("feature")))
    short = (w.where((n > 0) & (n < k))
             .select(entity, F.array_join("__w", " ").alias("feature")))
    return full.unionByName(short)
