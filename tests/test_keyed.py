import random

import pytest

from lakemart.operators.keyed import (
    KeyViolation,
    check_batch_keys,
    check_keys,
    dedup_any,
    dedup_latest,
    key_report,
    tie_break_columns,
    upsert,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_wins_and_null_recency_loses(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "z"), ("a", 2, "p"), ("a", 2, "q"), ("b", None, "n"), (None, 5, "k")],
        "id string, ts int, v string",
    )
    assert rows(dedup_latest(df, ["id"], "ts")) == rows(
        spark.createDataFrame([("a", 2, "q"), ("b", None, "n"), (None, 5, "k")], df.schema)
    )


def test_latest_with_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"k": "1"}), ("a", 1, {"k": "2"})], "id string, ts int, m map<string,string>")
    assert dedup_latest(df, ["id"], "ts").first().m == {"k": "2"}


def test_any_is_one_row_per_key_and_stable(spark):
    data = [(i % 7, random.Random(i).random()) for i in range(500)]
    one = rows(dedup_any(spark.createDataFrame(data, "id int, v double").repartition(5), ["id"]))
    two = rows(dedup_any(spark.createDataFrame(data[::-1], "id int, v double").repartition(3), ["id"]))
    assert one == two and len(one) == 7


def test_tie_break_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, ts int, v int")
    assert tie_break_columns(df, ["id"], "ts") == ["v"]
    assert tie_break_columns(df.select("id", "ts"), ["id"], "ts") == []


def test_upsert_is_null_safe_and_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "t"), (None, 2, "t"), ("c", 3, "t")], "id string, n int, v string")
    batch = spark.createDataFrame([("a", 1, "b"), (None, 2, "b"), ("d", 4, "b")], target.schema)
    once = upsert(target, batch, ["id", "n"])
    assert rows(once) == rows(
        spark.createDataFrame([("a", 1, "b"), (None, 2, "b"), ("c", 3, "t"), ("d", 4, "b")], target.schema)
    )
    assert rows(upsert(once, batch, ["id", "n"])) == rows(once)


def test_upsert_of_a_table_derived_from_itself(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = target.filter("id = 2").withColumn("v", target.v)
    assert rows(upsert(target, batch, ["id"])) == rows(target)


def test_upsert_evolves_columns(spark):
    target = spark.createDataFrame([(1, "old", "keep"), (2, "old", "keep")], "id int, v string, gone string")
    batch = spark.createDataFrame([(2, "new", 9), (3, "new", 8)], "id int, v string, extra int")
    got = {r.id: r.asDict() for r in upsert(target, batch, ["id"]).collect()}
    assert got[1] == {"id": 1, "v": "old", "gone": "keep", "extra": None}
    assert got[2] == {"id": 2, "v": "new", "gone": "keep", "extra": 9}
    assert got[3] == {"id": 3, "v": "new", "gone": None, "extra": 8}


def test_key_gate_counts(spark):
    df = spark.createDataFrame([(None, 1)] * 3 + [("a", 2)], "k string, n int")
    with pytest.raises(KeyViolation, match="k of t is NULL in 3"):
        check_keys(df, ["k"], "t")
    second = spark.createDataFrame([("a", None), ("a", 1)], "k string, n int")
    with pytest.raises(KeyViolation, match="n of t is NULL in 1"):
        check_keys(second, ["k", "n"], "t")
    repeated = spark.createDataFrame([("a", 1)] * 3, "k string, n int")
    with pytest.raises(KeyViolation, match="2 duplicate"):
        check_keys(repeated, ["k", "n"], "t")
    with pytest.raises(KeyViolation, match="repeats 1 key"):
        check_batch_keys(repeated, ["k", "n"], "t")


def test_joined_text_does_not_make_false_duplicates(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert key_report(df, ["x", "y"]).first().duplicates == 0
    check_keys(df, ["x", "y"], "t")


def test_empty_table_passes(spark):
    check_keys(spark.createDataFrame([], "k string"), ["k"], "t")
