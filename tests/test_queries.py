"""Every registered query against its SQL twin."""

import os
import pathlib
import subprocess
import sys

import pytest
from oracle import compare, connect

from lakemart.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry_module_needs_no_session():
    root = pathlib.Path(__file__).resolve().parent.parent
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
