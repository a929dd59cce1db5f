"""A training-data pipeline over the documents table, one operator per stage.

Each stage works on all rows that the one before has kept. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.columns import named, unused
from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.mixing import mixed
from lakemart.llm.near_text import keep_one
from lakemart.llm.queries_quality import TARGETS, fitted_domains, toxic_model
from lakemart.llm.queries_tokens import digests
from lakemart.llm.toxic_crf import toxicity
from lakemart.plans.lineage import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return docs.where(toxicity(F.col("text"), toxic_model(spark, docs, sf_dir))["score"] < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (0.8 of their 5-word shingles) the one with the smallest id stays."""
    return keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the text; no row goes."""
    cut = dedup_lines(docs, removed=unused(docs, "removed"))
    chars = F.length("text").cast("long").alias("n_chars")
    return cut.select(*(chars if c == "n_chars" else named(c) for c in docs.columns))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as its rate says, so that domains have their shares."""
    return mixed(docs, fitted_domains(spark, docs, sf_dir), list(TARGETS.values()))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left."""
    return digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_domains),
    ("bpe_codec", encode_documents),
]

#: The fitted stages can't be said in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
