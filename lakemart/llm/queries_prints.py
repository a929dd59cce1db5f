"""Registered query over fingerprints of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.bin_minhash import as_text, edited_pairs, likeness, neighbours, repeated
from lakemart.llm.registry import query, table


@query("op13_bin_minhash")
def bin_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    places = neighbours(docs)
    most = places.agg(F.max("n")).first()[0] or 0
    found = edited_pairs(docs, places).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
        "copies",
    )
    return repeated(found, "copies", most)
