"""Registered queries and the pipeline over the test tables."""

import os
import subprocess
import sys
import pathlib

import pytest
from oracle import compare, connect

import corpus_pipeline
from lakemart.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op2": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op3": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op4": {"query_id", "rank", "vec_id", "score"},
    "op5": {"doc_id", "held_out", "score", "predicted"},
    "op6": {"doc_id", "fingerprint", "component_id"},
    "op7": {"page_id", "host", "path", "rule", "verdict"},
    "op10": {"vec_id", "n_links", "component_id", "kept"},
    "op11": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op12": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op13": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    assert COLUMNS.get(name.split("_")[0], set()) <= set(rows.columns)
    if name in ORACLES:
        assert compare(rows, connect(FOLDER), ORACLES[name]) is None
    else:
        assert rows.count() > 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {row[0] for row in docs.select("doc_id").collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert clean.columns == docs.columns
    found = corpus_pipeline.run(spark, FOLDER)
    assert {row["doc_id"] for row in found.collect()} <= ids


def test_entry_works_without_the_subpackage(tmp_path):
    root = pathlib.Path(__file__).resolve().parents[2]
    code = (
        "import sys\n"
        "sys.modules['lakemart.llm'] = None\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op1_') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
