"""Registered queries over near-duplicates and repeated passages of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.registry import query, table
from lakemart.llm.simhash import simhash_components


@query("op6_simhash_bk_trees")
def simhash_bk_trees(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query("op8_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0), lambda n, span: n + span["end"] - span["start"])
    return found.select("doc_id", "text", "removed", gone.cast("long").alias("n_removed"))
