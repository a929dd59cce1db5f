"""Hot keys: found, spread over the partitions, and joined exactly."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators.skew import hot_keys, spread_join


@pytest.fixture
def many(spark):
    """A third of the rows under one key, another third without key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 500)
    return spark.range(6000).select("id", key.alias("k"))


@pytest.fixture
def one(spark):
    return spark.range(0, 400).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))


def test_hot_keys_are_found_whole(many):
    assert set(hot_keys(many, "k")) == {7, None}


def test_uniform_keys_are_a_plain_join(spark, one):
    uniform = spark.range(50000).select("id", (F.col("id") % 5000).alias("k"))
    assert hot_keys(uniform, "k") == []
    joined = spread_join(uniform, one, "k", "key", "left")
    assert "explode" not in joined._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, [], [7], [7, 8, 9, 399]])
def test_equal_to_the_plain_join(many, one, how, hot):
    want = many.join(one, F.col("k") == F.col("key"), how)
    got = spread_join(many, one, "k", "key", how, hot)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_no_partition_holds_the_hot_key_alone(spark, many, one):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = spread_join(many, one, "k", "key", "left")
        sizes = joined.groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 6000 / 3
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
