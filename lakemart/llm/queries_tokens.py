"""Registered queries over tokens: encoding round trip and counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.bpe_codec import round_trip
from lakemart.llm.registry import query, table
from lakemart.llm.text_segments import text_batches
from lakemart.llm.token_counts import token_count

RANKS = "byte_bpe_50k.tiktoken"
COUNTED = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def digests(docs: DataFrame) -> DataFrame:
    found = round_trip(F.col("text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    text_batches(docs.sparkSession)
    joined = F.array_join(F.col("_found.ids").cast("array<string>"), " ")
    return docs.withColumn("_found", found).select(
        "doc_id",
        F.size("_found.ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("_found.decoded", 256).alias("decoded_sha256"),
    )


@query("op2_bpe_codec")
def bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    text_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    count = token_count(F.col("text"), public_tokenizers.path(COUNTED))
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        count.alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
