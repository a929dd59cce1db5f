"""Registered queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm.dimension_scan import search
from lakemart.llm.pivot_index import near_duplicates
from lakemart.llm.registry import query, table


@query("op10_pivot_permutations")
def pivot_permutations(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


@query("op4_dimension_scan")
def dimension_scan(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"), "vec_id", "embedding")
