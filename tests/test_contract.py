import pytest
from pyspark.sql.types import StructType

from lakemart.operators.contract import (
    ContractViolation,
    cast_failures,
    check_contract,
    conform,
    conform_batch,
    schema_diff,
)

T = StructType.fromDDL


def test_additive_change_passes(spark):
    assert check_contract("t", T("id string, cmc double"), T("id string, cmc double, `set` string")) == ["set"]


def test_first_load_has_no_difference(spark):
    assert check_contract("t", None, T("id string")) == []


def test_nullability_does_not_count(spark):
    assert check_contract("t", T("id string not null"), T("id string")) == []


def test_removed_and_retyped_abort_together(spark):
    with pytest.raises(ContractViolation) as problem:
        check_contract("t", T("id string, cmc double, x int"), T("id string, cmc string"))
    assert "removed x" in str(problem.value) and "retyped cmc (double -> string)" in str(problem.value)


def test_allowed_break_passes_but_documentation_stays(spark):
    current, batch = T("id string, cmc double"), T("id string, y int")
    assert check_contract("t", current, batch, allow_break=True) == ["y"]
    with pytest.raises(ContractViolation, match="undocumented y"):
        check_contract("t", current, batch, documented=["id"], allow_break=True)
    with pytest.raises(ContractViolation, match="documented_missing z"):
        check_contract("t", current, batch, documented=["id", "y", "z"], allow_break=True)


def test_violation_is_not_a_key_violation():
    assert not issubclass(ContractViolation, RuntimeError)


def test_conform_and_failures(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "n string, v string")
    contract = T("n int, v string, extra double")
    assert [tuple(r) for r in conform(df, contract).collect()] == [(1, "a", None), (None, "b", None), (None, "c", None)]
    assert [tuple(r) for r in cast_failures(df, contract).collect()] == [("n", 1)]
    with pytest.raises(ContractViolation, match="n=1"):
        conform_batch(df, contract)
    assert conform_batch(df.filter("v <> 'b'"), contract).count() == 2


def test_equal_schemas_have_no_diff(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert schema_diff(df, df).count() == 0
