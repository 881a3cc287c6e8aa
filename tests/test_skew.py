"""Half of all rows on one key, joins forced to shuffle: the final plan splits the hot partition."""

import contextlib

import pytest
from pyspark.sql import functions as F

from quarry.operators import lsh
from quarry.operators import recommend as rec
from quarry.operators import relational as rel

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "16"}


@contextlib.contextmanager
def conf(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def ratings(spark):
    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return (spark.range(0, 200_000, numPartitions=16)
            .select(F.concat(F.lit("k"), "id").alias("key"), hot.alias("userId"), (F.col("id") % 4999).alias("movieId"),
                    (F.col("id") % 50).cast("double").alias("rating")))


def test_means_join_is_split(spark, ratings):
    with conf(spark):
        assert "skew=true" in final_plan(rec.means_and_interaction(ratings, user="movieId", item="userId"))
        assert "skew=true" in final_plan(rec.bias_predict(ratings, ratings, user="movieId", item="userId"))


def test_filter_in_is_split(spark, ratings):
    with conf(spark):
        assert "skew=true" in final_plan(rel.filter_in(ratings, "userId", spark.range(3000)))


def test_buckets_join_is_split(spark):
    bands = spark.range(0, 200_000, numPartitions=16).select(
        F.col("id").alias("entity"), F.lit(0).alias("band"),
        F.md5(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 9000).cast("string"))).alias("bucket"))
    with conf(spark):
        assert "skew=true" in final_plan(lsh.lsh_buckets(bands))
