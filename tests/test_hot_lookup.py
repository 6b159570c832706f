"""Lookups with hot keys equal a plain join; rows find their way by a filter, and without hot keys there is one join."""

import collections

import pytest
from pyspark.sql import functions as F

from contiglink.operators.hot import hot_lookup


def bag(df):
    return collections.Counter(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def sides(spark, hot):
    """3000 rows, half of them of one key if hot, some without a key or a partner."""
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")) if hot else F.col("id")
    left = spark.range(3000).select(F.when(F.col("id") % 11 != 0, key).cast("long").alias("k"), F.lit("x").alias("s"), F.col("id").alias("v"))
    right = left.where("k is not null and k % 5 != 1").groupBy("k", "s").agg(F.count("*").alias("n"), F.max("v").alias("most"))
    return left, right


@pytest.mark.parametrize("hot", [True, False])
def test_equals_a_join_without_an_anti_join(spark, hot):
    left, right = sides(spark, hot)
    for keys in (["k"], ["k", "s"]):
        r = right if "s" in keys else right.drop("s")
        got = hot_lookup(left, r, keys, "n", least=0) if hot else hot_lookup(left, r.withColumn("n", F.lit(1)), keys, "n", total=3000, least=0)
        assert bag(got.select("k", "s", "v", "most")) == bag(left.join(r.drop("n"), keys).select("k", "s", "v", "most"))
        assert "LeftAnti" not in plan(got) and plan(got).count("Join") == (2 if hot else 1)


def test_keys_of_different_types_are_told(spark):
    left, right = sides(spark, True)
    with pytest.raises(ValueError):
        hot_lookup(left, right.withColumn("k", F.col("k").cast("int")), ["k"], "n", least=0)
