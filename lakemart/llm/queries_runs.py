"""Registered query over periodic runs of the words of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.periodic_runs import runs_of
from lakemart.llm.registry import query, table
from lakemart.llm.text_segments import text_batches


@query("op12_synchronising_runs")
def synchronising_runs(spark: SparkSession, folder: str) -> DataFrame:
    text_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", runs_of(F.col("text"), F.col("doc_id")).alias("_found"))
    best = F.get("_found.runs", F.col("_found.best"))
    lines = F.transform("_found.runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("_found.runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * _found.runs[_found.best].length div _found.runs[_found.best].period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.col("_found.collapsed_sha256").alias("collapsed_sha256"),
    )
