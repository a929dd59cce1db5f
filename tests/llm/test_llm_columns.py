"""Every stage of the pipeline with extra columns whose names an operator could use itself."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
NAMES = "_id _row _cut removed _key _p _n _times _time rest mark id key node root th rh k1 unit cut first _found".split()


@pytest.mark.parametrize("at", range(4))
def test_clashing_columns(spark, at):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = docs.select("*", *(F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in NAMES))
    extra = extra.withColumn("a map", F.create_map(F.lit("k"), "doc_id"))
    stage = corpus_pipeline.STAGES[at][1]
    found = stage(spark, extra, FOLDER)
    assert found.columns == extra.columns
    plain = {row["doc_id"]: row["text"] for row in stage(spark, docs, FOLDER).collect()}
    rows = found.collect()
    assert {row["doc_id"]: row["text"] for row in rows} == plain
    for row in rows:
        assert all(row[name] == f"{name}{row['doc_id']}" for name in NAMES) and row["a map"] == {"k": row["doc_id"]}


def test_no_rows_and_null_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    none = docs.where("doc_id < 0")
    nulls = docs.limit(3).select("doc_id", F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0
    for _, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, nulls, FOLDER).count() >= 0
