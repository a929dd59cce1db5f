from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent
sys.path[:0] = [str(ROOT.parent), str(ROOT)]

from lakemart.session import local_session  # noqa: E402


# Started at import: column expressions at module level need a session.
SESSION = local_session(8, "6g")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of given columns."""

    def run(expression, schema="c string", row=(None,)):
        return spark.createDataFrame([row], schema).select(expression.alias("out")).first()["out"]

    return run
