"""Connected components by alternating star operations.

Each round hangs the larger neighbours of a node on its smallest one, then the same
with its smaller neighbours, until every node hangs on the smallest of its
component. A node with very many neighbours costs one row per edge; its minimum is
aggregated before the shuffle, and the join that hands it out can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.plans.lineage import delete, new_path


def _larger_to_smallest(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.distinct()


def _smaller_to_smallest(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def smallest_reachable(edges: DataFrame, left: str, right: str, node: str, root: str) -> DataFrame:
    """(node, root): each node of ``edges`` that isn't the smallest of its component, and that one.

    Nodes are longs. Edges with a NULL end and loops link nothing. An empty table
    gives an empty one.
    """
    spark = edges.sparkSession
    state = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")
    )
    state, before = state.where("a is not null and b is not null").distinct(), None
    path = None
    while True:
        last_path, path = path, new_path(spark, "components")
        _smaller_to_smallest(_larger_to_smallest(state)).write.parquet(path)
        state = spark.read.schema("a long, b long").parquet(path)
        # The star form is a fixed point, so a table that stays the same is done.
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if last_path:
            delete(spark, last_path)
        if now == before:
            return state.select(F.col("a").alias(node), F.col("b").alias(root))
        before = now
