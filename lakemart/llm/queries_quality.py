"""Registered queries that score and weigh whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.mixing import Domains, copies, fit_domains, fit_steps, rates
from lakemart.llm.registry import query, table
from lakemart.llm.toxic_crf import Model, toxicity, train
from lakemart.plans.lineage import cut_lineage

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt; a row without an id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def toxic_model(spark: SparkSession, docs: DataFrame, folder: str) -> Model:
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return train(docs, labels.where(~held_out(F.col("doc_id"))))


@query("op5_toxic_crf")
def toxic_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.withColumn("_found", toxicity(F.col("text"), toxic_model(spark, docs, folder)))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_found.score").alias("score"),
        (F.col("_found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("_found.spans").alias("spans"),
    )


# The domains and the shares of words that the mix should have.
TARGETS = {"good": 0.92, "poor": 0.08}


def domain_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    quality = F.col("quality")
    domain = F.when(quality == 1, "good").when(quality == 0, "poor")
    return table(spark, folder, "labels").select("doc_id", domain.alias("domain"))


def fitted_domains(spark: SparkSession, docs: DataFrame, folder: str) -> Domains:
    return fit_domains(docs, domain_labels(spark, folder), list(TARGETS))


@query("op9_soft_mixing")
def soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = fitted_domains(spark, docs, folder).posteriors(docs)
    members = cut_lineage(found.select("doc_id", "_n", "_p", F.xxhash64("text").alias("_hash")), "members")
    return rates(members, fit_steps(members, list(TARGETS.values()))).select(
        "doc_id",
        F.col("_n").alias("n_words"),
        *(F.col("_p")[i].alias(f"p_{name}") for i, name in enumerate(TARGETS)),
        "rate",
        copies(F.col("rate"), F.col("doc_id"), F.col("_hash")).alias("copies"),
    )
