"""Dimension, fact, checks and audit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators.dimension import build_fact, changed_ids, incremental_slice, latest_event
from lakemart.operators.quality import (
    Check,
    DataQualityError,
    any_negative,
    any_null,
    enforce,
    run_checks,
    summary_text,
)
from lakemart.plans.mart import MartSpec, QuoteSource, may_increment, refresh_mart
from lakemart.plans.runlog import AUDIT_TABLE, audit_run
from lakemart.plans.store import TableStore


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def report(spark, counts, limits):
    df = spark.createDataFrame([(k, i) for k, n in counts.items() for i in range(n)] + [("", 0)], "k string, i int")
    return run_checks(df, [Check(k, F.count_if(F.col("k") == k), limits.get(k, 0)) for k in limits])


def test_limits(spark):
    assert enforce(report(spark, {}, {"a": 0}), "t") == {"a": 0}
    assert enforce(report(spark, {"a": 74}, {"a": 120}), "t") == {"a": 74}
    assert enforce(report(spark, {"a": 400}, {"a": None}), "t") == {"a": 400}
    with pytest.raises(DataQualityError, match="a=1") as problem:
        enforce(report(spark, {"a": 1, "b": 5}, {"a": 0, "b": None, "c": 0}), "t")
    assert problem.value.results == {"a": 1, "b": 5, "c": 0}


def test_null_count_is_zero(spark):
    empty = spark.createDataFrame([], "v int")
    assert enforce(run_checks(empty, [Check("m", F.max("v"))]), "t") == {"m": 0}


def test_predicates_ignore_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (-1.0, None), (None, None), (2.0, 3.0)], "a double, b double")
    checks = [Check("neg", F.count_if(any_negative("a", "b")), None), Check("nul", F.count_if(any_null("a", "b")), None)]
    assert enforce(run_checks(df, checks), "t") == {"neg": 1, "nul": 3}


def test_latest_event_nulls_lose(spark):
    df = spark.createDataFrame([("a", None, 9, "x"), ("a", 1, 2, "y"), ("a", 1, 3, "z")], "k string, t int, id int, v string")
    assert rows(latest_event(df, "k", ["t", "id"], ["v"])) == [("a", "z")]


def test_changed_ids_see_new_altered_and_nulls_not_deleted(spark):
    schema = "id string, v string, n int"
    old = spark.createDataFrame([("a", "1", None), ("b", "1", 1), ("gone", "1", 1)], schema)
    new = spark.createDataFrame([("a", "1", None), ("b", "2", 1), ("c", None, None)], schema)
    assert rows(changed_ids(new, old, "id")) == [("b",), ("c",)]


def test_slice_has_no_row_twice_and_keeps_null_times_of_changed(spark):
    quotes = spark.createDataFrame(
        [("a", 2024, dt.datetime(2024, 1, 1)), ("a", 2025, dt.datetime(2025, 1, 1)), ("b", 2024, dt.datetime(2024, 1, 1)),
         ("b", 2025, dt.datetime(2025, 1, 1)), ("a", None, None)],
        "id string, y int, t timestamp",
    )
    changed = spark.createDataFrame([("a",)], "id string")
    got = incremental_slice(quotes, changed, "id", "t", dt.datetime(2024, 6, 1), "y")
    assert rows(got.groupBy("id").count()) == [("a", 3), ("b", 1)]


def test_first_branch_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    spark.createDataFrame([("a", 2024, dt.datetime(2024, 1, 1))], "id string, y int, t timestamp").write.partitionBy("y").parquet(path)
    changed = spark.createDataFrame([("a",)], "id string")
    got = incremental_slice(spark.read.parquet(path), changed, "id", "t", dt.datetime(2025, 6, 1), "y")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" not in plan and "GreaterThan(t,2025-06-01" in plan
    assert "y#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_when_to_increment():
    assert may_increment(False, True, ["a", "b"], ["a", "b"])
    assert not may_increment(True, True, ["a"], ["a"])
    assert not may_increment(False, False, ["a"], ["a"])
    assert not may_increment(False, True, None, ["a"])
    assert not may_increment(False, True, ["b", "a"], ["a", "b"])


def assemble(quotes, dim, hot):
    return quotes.withColumnRenamed("t", "quoted").join(dim, "id")


SPEC = MartSpec("dim", "fact", "id", "t", "y", "quoted", ("y",), assemble)
QUOTES = "id string, t timestamp, y int, price double"
DIM = "id string, name string"


def quote(member, year, price=1.0):
    return (member, dt.datetime(year, 1, 1), year, price)


def test_three_runs_equal_a_rebuild(spark, store, tmp_path):
    def run(target, dim, quotes, **options):
        return refresh_mart(
            target, SPEC, spark.createDataFrame(dim, DIM), spark.createDataFrame(quotes, QUOTES), **options
        )

    first = [quote("a", 2020), quote("b", 2020), quote("a", 2021), quote("unknown", 2021)]
    assert run(store, [("a", "A"), ("b", "B")], first) == 3
    assert run(store, [("a", "A"), ("b", "B")], first) == 0
    later = first + [quote("b", 2022), quote("c", 2022)]
    members = [("a", "A2"), ("b", "B"), ("c", "C")]
    assert run(store, members, later) == 4
    rebuilt = TableStore(spark, str(tmp_path / "other"))
    run(rebuilt, members, later)
    for table in ("fact", "dim"):
        assert rows(store.read(table)) == rows(rebuilt.read(table))
    late = later + [quote("b", 2019)]
    assert run(store, members, late) == 0
    assert run(store, members, late, rebuild=True) == 6


def test_failed_fact_leaves_the_changes_to_be_found_again(spark, store, monkeypatch):
    quotes = spark.createDataFrame([quote("a", 2020), quote("b", 2020)], QUOTES)
    refresh_mart(store, SPEC, spark.createDataFrame([("a", "A"), ("b", "B")], DIM), quotes)
    new = spark.createDataFrame([("a", "A2"), ("b", "B")], DIM)
    broken = TableStore.replace_partitions
    monkeypatch.setattr(TableStore, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        refresh_mart(store, SPEC, new, quotes)
    assert rows(store.read("dim")) == [("a", "A"), ("b", "B")]
    monkeypatch.setattr(TableStore, "replace_partitions", broken)
    assert refresh_mart(store, SPEC, new, quotes) == 1
    assert rows(store.read("fact").select("id", "name")) == [("a", "A2"), ("b", "B")]


def audit_of(store, body):
    with pytest.raises(Exception) if body else pytest.MonkeyPatch.context():
        with audit_run(store, "t") as audit:
            audit.read, audit.processed = 9, 5
            if body:
                body(audit)
    return store.read(AUDIT_TABLE).orderBy(F.desc("DT_INICIO")).first()


def test_audit_outcomes(store):
    def raising(problem, saving=False):
        def body(audit):
            if saving:
                with audit.saving():
                    raise problem
            raise problem

        return body

    row = audit_of(store, None)
    assert (row.DESC_STATUS, row.QTD_LIDOS, row.QTD_INSERIDOS_ATUALIZADOS) == ("SUCESSO", 9, 5)
    assert row.DESC_DQ_RESULTADO == "sem checagens"
    row = audit_of(store, raising(DataQualityError("dq", {"a": 1, "b": 0})))
    assert (row.DESC_STATUS, row.QTD_INSERIDOS_ATUALIZADOS, row.DESC_DQ_RESULTADO) == ("FALHA_DQ", 5, "a=1, b=0")
    row = audit_of(store, raising(RuntimeError("it's a key"), saving=True))
    assert (row.DESC_STATUS, row.QTD_INSERIDOS_ATUALIZADOS) == ("FALHA_DQ_PK", 0)
    row = audit_of(store, raising(ValueError("contract"), saving=True))
    assert (row.DESC_STATUS, row.QTD_INSERIDOS_ATUALIZADOS) == ("FALHA", 0)
    assert store.read(AUDIT_TABLE).count() == 4


def test_summary():
    assert summary_text({}) == "sem checagens"
    assert summary_text({"a": 1, "b": 2}) == "a=1, b=2"


def _quotes_mart():
    spec = MartSpec(
        "dim", "fact", "id", "day", "y", "day", ("y",),
        lambda quotes, dim, hot: build_fact(quotes, dim, "id", hot),
        quote_columns=("id", "day", "price"),
        quote_partitions=("y",),
    )
    start = dt.datetime(2020, 1, 1)
    rows = [(f"m{i % 5}", start + dt.timedelta(days=40 * i), float(i)) for i in range(60)]
    return spec, [(m, day, price, day.year) for m, day, price in rows]


def test_late_and_withdrawn_quotes_reach_the_fact(spark, store, monkeypatch):
    """Only partitions whose quotes differ are made anew, and the fact equals a rebuild."""
    spec, rows = _quotes_mart()
    schema = "id string, day timestamp, price double, y int"
    dim = spark.createDataFrame([(f"m{i}", f"name {i}") for i in range(5)], "id string, name string")
    anew = []
    real = TableStore.replace_partitions

    def seen(self, df, table, by, touched):
        anew.extend(sorted(r["y"] for r in df.select("y").distinct().collect()) if table == "fact" else [])
        return real(self, df, table, by, touched)

    monkeypatch.setattr(TableStore, "replace_partitions", seen)

    def run(quotes, members=dim):
        store.overwrite(spark.createDataFrame(quotes, schema), "quotes", ["y"])
        # Folders of equal rows get new file names too, so only prints tell what differs.
        del anew[:]
        done = refresh_mart(store, spec, members, store.read("quotes"), source=QuoteSource(store, "quotes"))
        want = build_fact(spark.createDataFrame(quotes, schema), members, "id", [])
        columns = sorted(want.columns)
        fact = store.read("fact").select(columns)
        assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, want.select(columns).collect()))
        return done

    late = [row for row in rows if row[3] == 2021 and row[2] % 2 == 0]
    assert run([row for row in rows if row not in late]) == 60 - len(late)
    assert run(rows) == sum(row[3] == 2021 for row in rows) and anew == [2021]
    assert run(rows) == 0 and anew == []
    # One quote goes, one changes its price: no time tells of either.
    fewer = [row for row in rows if row[2] != 7.0]
    changed = [(m, day, -1.0 if price == 30.0 else price, y) for m, day, price, y in fewer]
    run(changed)
    years = {row[3] for row in rows if row[2] in (7.0, 30.0)}
    assert set(anew) == years
    # A changed member reaches its quotes in the other partitions.
    renamed = spark.createDataFrame([(f"m{i}", "new" if i == 3 else f"name {i}") for i in range(5)], "id string, name string")
    assert run(changed, renamed) == sum(row[0] == "m3" for row in changed)


def test_a_run_that_fails_makes_the_same_partitions_again(spark, store, monkeypatch):
    spec, rows = _quotes_mart()
    schema = "id string, day timestamp, price double, y int"
    dim = spark.createDataFrame([(f"m{i}", f"name {i}") for i in range(5)], "id string, name string")
    source = QuoteSource(store, "quotes")
    store.overwrite(spark.createDataFrame(rows[:40], schema), "quotes", ["y"])
    refresh_mart(store, spec, dim, store.read("quotes"), source=source)
    store.overwrite(spark.createDataFrame(rows, schema), "quotes", ["y"])
    real = TableStore.overwrite

    def broken(self, df, table, *args, **kwargs):
        if table.endswith("__made_from"):
            raise OSError("gone")
        return real(self, df, table, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(TableStore, "overwrite", broken)
        with pytest.raises(OSError):
            refresh_mart(store, spec, dim, store.read("quotes"), source=source)
    assert refresh_mart(store, spec, dim, store.read("quotes"), source=source) > 0
    assert store.read("fact").count() == 60
