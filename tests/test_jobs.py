"""Landing, incremental load, keyed saves, ledger and stream on real folders."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from lakemart.operators.contract import ContractViolation
from lakemart.operators.increment import new_snapshots, read_increment, window_members
from lakemart.operators.keyed import KeyViolation
from lakemart.plans.bronze import load_new_snapshots
from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.landing import land_snapshot
from lakemart.plans.runlog import run_logged
from lakemart.plans.store import TableStore
from lakemart.sources.json_source import rejected_lines, scan_jsonl, scan_pages
from lakemart.sources.snapshots import list_snapshots
from lakemart.streaming.file_ingest import ingest_new_files

DAY = dt.datetime(2026, 9, 5, 10, 0)
NEXT = dt.datetime(2026, 10, 5, 10, 0)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def prices(spark, data):
    return spark.createDataFrame(data, "id string, releaseDate string, usd string")


def test_landing_writes_each_month_once_a_day(spark, tmp_path):
    root = str(tmp_path / "stage")
    df = prices(spark, [("a", "2021-03-01", "1"), ("b", "2021-04-01", "2"), ("c", None, "3")])
    run = {}
    landed = land_snapshot(df, root, "card_prices", DAY, date_column="releaseDate", run=run)
    assert landed.columns == ["id", "releaseDate", "usd", "ingestion_timestamp", "source", "endpoint"]
    assert run == {"records_read": 3, "files_written": 3, "files_skipped": 0, "records_written": 3}
    names = {pathlib.Path(r.path).name for r in list_snapshots(spark, f"{root}/card_prices").collect()}
    assert names == {f"snapshot={m}_20260905_card_prices.parquet" for m in ("2021_03", "2021_04", "2026_09")}
    land_snapshot(df, root, "card_prices", DAY, date_column="releaseDate", run=run)
    assert run == {"records_read": 3, "files_written": 0, "files_skipped": 3, "records_written": 0}
    land_snapshot(df, root, "card_prices", NEXT, date_column="releaseDate", run=run)
    assert run["files_written"] == 3


def test_half_written_month_is_replaced(spark, tmp_path):
    root, run = str(tmp_path / "stage"), {}
    df = prices(spark, [("a", "2021-03-01", "1"), ("b", "2021-04-01", "2")])
    land_snapshot(df, root, "card_prices", DAY, date_column="releaseDate")
    folder = tmp_path / "stage/card_prices/snapshot=2021_03_20260905_card_prices.parquet"
    (folder / "_SUCCESS").unlink()
    land_snapshot(df, root, "card_prices", DAY, date_column="releaseDate", run=run)
    assert run == {"records_read": 2, "files_written": 1, "files_skipped": 1, "records_written": 1}
    assert spark.read.parquet(str(folder)).count() == 1


def test_landing_window_and_mandatory_columns(spark, tmp_path):
    root = str(tmp_path / "stage")
    df = prices(spark, [("a", "2020-12-31", "1"), ("b", "2021-01-01", None), ("c", None, "1")])
    run = {}
    kept = land_snapshot(df, root, "p", DAY, date_column="releaseDate", cutoff=dt.date(2021, 1, 1), run=run)
    assert (run["records_read"], run["records_written"]) == (3, 1)
    assert [r.id for r in kept.collect()] == ["b"]
    with pytest.raises(ValueError, match=r"'usd': 1"):
        land_snapshot(df, root, "q", DAY, required=["id", "usd"])
    assert not (tmp_path / "stage/q").exists()
    assert land_snapshot(df.filter("false"), root, "r", DAY) is None


def test_listing_ignores_unfinished_folders(spark, tmp_path):
    base = tmp_path / "cards"
    for name, files in {
        "x.parquet": ["part-0.parquet", "_SUCCESS"],
        "y.parquet": ["_started_1"],
        "z.parquet": ["part-0.parquet"],
        "other": ["part-0.parquet"],
    }.items():
        (base / name).mkdir(parents=True)
        for file in files:
            (base / name / file).touch()
    (base / "_SUCCESS").touch()
    found = {pathlib.Path(r.path).name: r.complete for r in list_snapshots(spark, str(base)).collect()}
    assert found == {"x.parquet": True, "y.parquet": False, "z.parquet": False}


def test_loaded_files_are_not_new(spark):
    listed = spark.createDataFrame([("s3://b/1_cards.parquet",), ("s3://b/2_cards.parquet",)], "path string")
    loaded = spark.createDataFrame([("s3a://b/1_cards.parquet/part-0.parquet",)], "source_file string")
    assert [r.path for r in new_snapshots(listed, loaded).collect()] == ["s3://b/2_cards.parquet"]


def test_bronze_appends_only_new_snapshots(spark, tmp_path, store):
    root = str(tmp_path / "stage")
    df = prices(spark, [("a", "2021-03-01", "1"), ("b", "2021-04-01", "2")])
    land_snapshot(df, root, "p", DAY, date_column="releaseDate")
    _, run = load_new_snapshots(store, root, "p", DAY)
    assert (run["files_processed"], run["records_written"], run["status"]) == (2, 2, "SUCCESS")
    nothing, run = load_new_snapshots(store, root, "p", DAY)
    assert nothing is None and run["records_written"] == 0 and run["status"] == "SUCCESS"
    land_snapshot(df.withColumn("eur", F.lit("9")), root, "p", NEXT, date_column="releaseDate")
    load_new_snapshots(store, root, "p", NEXT)
    table = store.read("p")
    assert table.count() == 4 and table.filter("eur IS NULL").count() == 2
    assert {"source_file", "bronze_run_id", "bronze_ingestion_timestamp"} <= set(table.columns)
    land_snapshot(df.drop("usd"), root, "p", NEXT + dt.timedelta(days=1), date_column="releaseDate")
    with pytest.raises(ContractViolation, match="removed eur; removed usd"):
        load_new_snapshots(store, root, "p", NEXT)
    log = store.read("run_log")
    assert rows(log.groupBy("status").count()) == [("FAILED", 1), ("SUCCESS", 3)]
    assert "removed eur" in log.filter("status = 'FAILED'").first().error


def test_ledger_failure_does_not_change_the_outcome(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.touch()
    broken = TableStore(spark, str(blocked))
    result, run = run_logged(broken, "t", lambda run: "done", DAY)
    assert result == "done" and run["status"] == "SUCCESS"
    with pytest.raises(ValueError, match="boom"):
        run_logged(broken, "t", lambda run: (_ for _ in ()).throw(ValueError("boom")), DAY)


def test_empty_input_fails_a_landing_run(store):
    with pytest.raises(ValueError, match="no data"):
        run_logged(store, "t", lambda run: None, DAY, empty_fails=True)
    assert store.read("run_log").first().status == "FAILED"


def test_increment_after_high_water_mark(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "ts int")
    empty = source.filter("false")
    assert read_increment(source, None, "ts").count() == 3
    assert read_increment(source, empty, "ts").count() == 3
    assert rows(read_increment(source, source.filter("ts < 3"), "ts")) == [(3,)]


def test_window_members_ignore_case_and_nulls(spark):
    cards = spark.createDataFrame([("qmv",), ("QMV",), ("old",), (None,)], "set string")
    codes = spark.createDataFrame([("QMV",), (None,)], "code string")
    assert window_members(cards, "set", codes, "code").count() == 2


KEYED = "id string, y int, ts int, v string"


def test_rows_moving_between_partitions_leave_no_copy(spark, store):
    first = spark.createDataFrame([("a", 2024, 1, "a1"), ("b", 2024, 1, "b1"), ("c", 2023, 1, "c1")], KEYED)
    save_keyed(first, store, "t", ["id"], "ts", ["y"])
    batch = spark.createDataFrame([("c", 2025, 2, "c2"), ("b", 2024, 0, "b0"), ("b", 2024, 2, "b2")], KEYED)
    for _ in range(2):
        save_keyed(batch, store, "t", ["id"], "ts", ["y"])
        got = {r.id: (r.y, r.v) for r in store.read("t").collect()}
        assert got == {"a": (2024, "a1"), "b": (2024, "b2"), "c": (2025, "c2")}
        assert store.read("t").count() == 3


def test_only_touched_partitions_are_rewritten(spark, store, tmp_path):
    first = spark.createDataFrame([(str(y), y, 1, "old") for y in range(2020, 2026)], KEYED)
    save_keyed(first, store, "t", ["id"], "ts", ["y"])
    files = lambda: {str(p) for p in (tmp_path / "tables/t").rglob("part-*")}
    before = files()
    save_keyed(first.filter("y = 2021").withColumn("v", F.lit("new")), store, "t", ["id"], "ts", ["y"])
    assert len(before - files()) == 1 and len(files() - before) == 1


def test_null_partition_and_null_key_part(spark, store):
    first = spark.createDataFrame([("a", None, 1, "old"), ("b", 2024, 1, "old")], KEYED)
    save_keyed(first, store, "t", ["id"], "ts", ["y"])
    save_keyed(spark.createDataFrame([("a", None, 2, "new")], KEYED), store, "t", ["id"], "ts", ["y"])
    assert {r.id: r.v for r in store.read("t").collect()} == {"a": "new", "b": "old"}
    save_keyed(spark.createDataFrame([("a", 2020, 3, "moved")], KEYED), store, "t", ["id"], "ts", ["y"])
    assert rows(store.read("t").select("id", "y")) == [("a", 2020), ("b", 2024)]


def test_interrupted_replacement_is_finished_by_the_next_writer(spark, store, monkeypatch):
    first = spark.createDataFrame([("a", 2024, 1, "old"), ("b", 2023, 1, "old")], KEYED)
    save_keyed(first, store, "t", ["id"], "ts", ["y"])
    finish = TableStore.recover
    monkeypatch.setattr(TableStore, "recover", lambda self, table: None)
    save_keyed(spark.createDataFrame([("a", 2023, 2, "new")], KEYED), store, "t", ["id"], "ts", ["y"])
    monkeypatch.setattr(TableStore, "recover", finish)
    # Readers see the published rows and leave the pending replacement alone.
    assert {r.v for r in store.read("t").collect()} == {"old"}
    assert (pathlib.Path(store.root) / "t/replacing.json").exists()
    save_keyed(spark.createDataFrame([], KEYED), store, "t", ["id"], "ts", ["y"])
    assert rows(store.read("t").select("id", "y", "v")) == [("a", 2023, "new"), ("b", 2023, "old")]


def test_first_write_is_deduplicated_and_a_bad_key_is_not_published(spark, store):
    save_keyed(spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], KEYED), store, "t", ["id"], "ts")
    assert rows(store.read("t").select("v")) == [("y",)]
    with pytest.raises(KeyViolation, match="NULL in 1"):
        save_keyed(spark.createDataFrame([(None, 1, 1, "x")], KEYED), store, "u", ["id"], "ts")
    assert not store.exists("u")


def test_abort_on_duplicates_writes_nothing(spark, store):
    good = spark.createDataFrame([("a", 1, 1, "x")], KEYED)
    bad = good.union(good)
    with pytest.raises(KeyViolation):
        save_keyed(bad, store, "t", ["id"], on_duplicate="abort", mode="overwrite")
    save_keyed(good, store, "t", ["id"], on_duplicate="abort", mode="overwrite")
    for mode in ("overwrite", "upsert"):
        with pytest.raises(KeyViolation):
            save_keyed(bad.withColumn("v", F.lit("z")), store, "t", ["id"], on_duplicate="abort", mode=mode)
        assert rows(store.read("t").select("v")) == [("x",)]


def test_null_key_in_a_later_batch_leaves_the_table_alone(spark, store):
    save_keyed(spark.createDataFrame([("a", 1, 1, "x")], KEYED), store, "t", ["id"], "ts", ["y"])
    with pytest.raises(KeyViolation, match="id of t is NULL in 1"):
        save_keyed(spark.createDataFrame([(None, 1, 2, "z")], KEYED), store, "t", ["id"], "ts", ["y"])
    assert rows(store.read("t").select("v")) == [("x",)]


def test_old_versions_go(spark, store, tmp_path):
    for v in "abcd":
        save_keyed(spark.createDataFrame([("a", 1, 1, v)], KEYED), store, "t")
    store.drop_old_versions("t", keep=1)
    assert [p.name for p in (tmp_path / "tables/t").glob("v=*")] == ["v=4"]
    assert rows(store.read("t").select("v")) == [("d",)]


def test_overwrite_without_key_reads_its_own_table(spark, store):
    save_keyed(spark.createDataFrame([("a", 1, 1, "x")], KEYED), store, "t")
    save_keyed(store.read("t").withColumn("v", F.lit("y")), store, "t")
    assert rows(store.read("t").select("v")) == [("y",)]


def test_contract_guards_saves_and_new_columns_come_in(spark, store):
    save_keyed(spark.createDataFrame([("a", 1, 1, "x")], KEYED), store, "t", ["id"], "ts", ["y"])
    with pytest.raises(ContractViolation, match="removed v"):
        save_keyed(store.read("t").drop("v"), store, "t", ["id"], "ts", ["y"])
    more = spark.createDataFrame([("b", 1, 1, "x", 5)], KEYED + ", n int")
    save_keyed(more, store, "t", ["id"], "ts", ["y"])
    assert {r.id: r.n for r in store.read("t").collect()} == {"a": None, "b": 5}
    typed = spark.createDataFrame([("b", 1, 2, 7, 5)], KEYED.replace("v string", "v int") + ", n int")
    with pytest.raises(ContractViolation, match="retyped v"):
        save_keyed(typed, store, "t", ["id"], "ts", ["y"])
    with pytest.raises(ContractViolation, match="v=2"):
        save_keyed(typed, store, "t", ["id"], "ts", ["y"], allow_break=True)
    assert {r.id: r.v for r in store.read("t").collect()} == {"a": "x", "b": "x"}
    digits = spark.createDataFrame([("a", 1, 1, "4", 0), ("b", 1, 1, "5", 0)], KEYED + ", n int")
    save_keyed(digits, store, "t", ["id"], "ts", ["y"])
    save_keyed(typed, store, "t", ["id"], "ts", ["y"], allow_break=True)
    assert {r.id: r.v for r in store.read("t").collect()} == {"a": 4, "b": 7}


def test_appends_keep_the_types_of_a_table(spark, store):
    store.append(spark.createDataFrame([(1, 5)], "id int, v int"), "t")
    text = spark.createDataFrame([(2, "x")], "id int, v string")
    with pytest.raises(ContractViolation, match="retype v"):
        store.append(text, "t")
    assert rows(store.read("t")) == [(1, 5)]
    store.append(text, "t", allow_break=True)
    assert rows(store.read("t")) == [(1, "5"), (2, "x")]
    with pytest.raises(ContractViolation, match="v=1"):
        store.append(spark.createDataFrame([(3, 7)], "id int, v int"), "t", allow_break=True)


def half_written(spark, base):
    """One snapshot of three rows whose write broke off after one of them."""
    df = prices(spark, [(i, "2021-03-01", "1") for i in "abc"])
    land_snapshot(df, base, "p", DAY, date_column="releaseDate")
    folder = pathlib.Path(base) / "p/snapshot=2021_03_20260905_p.parquet"
    landed = spark.read.parquet(str(folder))
    schema, first = landed.schema, landed.take(1)
    for file in folder.iterdir():
        file.unlink()
    spark.createDataFrame(first, schema).write.mode("append").parquet(str(folder))
    for marker in folder.glob("*_SUCCESS*"):
        marker.unlink()
    return df, schema


def test_half_written_snapshots_wait_until_they_are_whole(spark, tmp_path, store):
    base = str(tmp_path / "stage")
    df, schema = half_written(spark, base)
    nothing, run = load_new_snapshots(store, base, "p", DAY)
    assert nothing is None and run["files_processed"] == 0
    ingest_new_files(store, f"{base}/p", schema, "s", str(tmp_path / "check"), DAY)
    assert not store.exists("s")
    land_snapshot(df, base, "p", DAY, date_column="releaseDate")
    for _ in range(2):
        load_new_snapshots(store, base, "p", DAY)
        ingest_new_files(store, f"{base}/p", schema, "s", str(tmp_path / "check"), DAY)
    assert store.read("p").count() == store.read("s").count() == 3


@pytest.mark.parametrize("feed", ["cards", "sets", "card_prices", "rulings", "migrations"])
def test_a_broken_line_fails_the_run(spark, tmp_path, store, feed):
    from lakemart.domain.cards import jobs, schemas

    schema = getattr(schemas, {"cards": "RAW_CARD", "card_prices": "RAW_CARD", "sets": "RAW_SET",
                               "rulings": "RAW_RULING", "migrations": "RAW_MIGRATION"}[feed])
    lines = tmp_path / "feed.jsonl"
    lines.write_text('{"id": "a", "released_at": "2026-01-01", "set": "s", "code": "s"}\n{"id": "b", "rel\n')
    sets = tmp_path / "sets.jsonl"
    sets.write_text('{"code": "s", "released_at": "2026-01-01"}\n')
    raw_sets = scan_jsonl(spark, str(sets), schemas.RAW_SET)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        jobs.run_stage(scan_jsonl(spark, str(lines), schema), feed, store, str(tmp_path / "stage"), DAY,
                       raw_sets=raw_sets)
    assert not list((tmp_path / "stage").rglob("*.parquet")) if (tmp_path / "stage").exists() else True
    assert [r.status for r in store.read("run_log").collect()] == ["FAILED"]


def test_a_truncated_page_fails_and_pages_have_numbers(spark, tmp_path):
    schema = spark.createDataFrame([], "id int").schema
    for page in (2, 10, 1):
        (tmp_path / f"page-{page}.json").write_text('{"data": [{"id": %d}]}' % page)
    pages = scan_pages(spark, str(tmp_path), schema)
    assert [r.id for r in pages.orderBy("_page", "_position").collect()] == [1, 2, 10]
    (tmp_path / "page-3.json").write_text('{"data": [{"id": 3}, {"id"')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        scan_pages(spark, str(tmp_path), schema).collect()


def test_rejected_lines(spark):
    schema = spark.createDataFrame([], "id int").schema
    text = spark.createDataFrame([('{"id": 1}',), ('{"id"',), (" ",), (None,)], "line string")
    assert [r.line for r in rejected_lines(text, "line", schema).collect()] == ['{"id"']


def test_stream_takes_each_file_once(spark, tmp_path, store):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    df.coalesce(1).write.parquet(source)
    sizes = []
    for extra in (False, False, True):
        if extra:
            df.limit(2).coalesce(1).write.mode("append").parquet(source)
        ingest_new_files(store, source, df.schema, "s", checkpoint, DAY)
        sizes.append(store.read("s").count())
    assert sizes == [3, 3, 5]
    assert store.read("run_log").filter("status = 'SUCCESS'").count() == 2


def test_json_lines_and_pages(spark, tmp_path):
    import gzip
    import json

    schema = spark.createDataFrame([], "id int, name string").schema
    lines = tmp_path / "bulk.jsonl.gz"
    with gzip.open(lines, "wt") as out:
        out.write('{"id": 1, "name": "a"}\n\n{"id": 2}\n')
    assert rows(scan_jsonl(spark, str(lines), schema)) == [(1, "a"), (2, None)]
    for page, ids in {"1": [1, 2, 3], "2": [4, 5]}.items():
        (tmp_path / f"page-{page}.json").write_text(json.dumps({"data": [{"id": i} for i in ids]}, indent=1))
    pages = scan_pages(spark, str(tmp_path / "page-*.json"), schema)
    assert [r.id for r in pages.orderBy("_page", "_position").collect()] == [1, 2, 3, 4, 5]
