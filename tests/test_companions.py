"""Statistics kept per partition: key index, counters, reference counts, prints, closure."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import closure
from lakemart.operators.chain import ended_at, resolve_chain, walks
from lakemart.operators.dimension import changed_ids, changed_prints, member_prints
from lakemart.operators.quality import Check, run_checks
from lakemart.plans import companion, refcounts
from lakemart.plans.counters import check_counters, check_table, heavy_keys, newest
from lakemart.plans.key_index import folders_with
from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.reconcile import differing_partitions, row_prints, stored_prints
from lakemart.plans.refcounts import reference_counts, unmatched_counts
from lakemart.plans.store import TableStore
from lakemart.streaming.keyed_stream import save_batch, upsert_stream

SCHEMA = "id string, part string, n int"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


@pytest.fixture
def table(spark, store):
    def write(data, mode="upsert"):
        save_keyed(
            spark.createDataFrame(data, SCHEMA), store, "t", ["id"], partition_by=["part"], mode=mode
        )
        return store.read("t")

    return write


def random_rows(pick, n, ids=200, parts=6):
    chosen = pick.sample(range(ids), n)
    return [(f"k{i}", pick.choice(["a b", "é", None, "x=1", *map(str, range(parts))]), pick.randrange(100)) for i in chosen]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CHECKS = [Check("low", F.count_if(F.col("n") < 10)), Check("no_part", F.count_if(F.col("part").isNull()), None)]


def test_statistics_follow_random_upserts(spark, store, table):
    """After each run all of them equal a full scan."""
    pick = random.Random(1)
    expected = {}
    for run in range(5):
        batch = random_rows(pick, 40 if run else 150)
        expected |= {row[0]: row for row in batch}
        stored = table(batch)
        assert bag(stored.select("id", "part", "n")) == sorted(expected.values(), key=repr)
        assert bag(check_table(store, "t", CHECKS)) == bag(run_checks(stored, CHECKS))
        assert newest(store, "t", "n") == max(row[2] for row in expected.values())
        counted = stored.groupBy(F.col("part").alias("id")).agg(F.count("*").alias("n")).where("id is not null")
        assert bag(reference_counts(store, "t", "part")) == bag(counted)
        assert bag(stored_prints(store, "t", ["part"], ["id", "n"])) == bag(row_prints(stored, ["part"], ["id", "n"]))
        # A second look reads nothing.
        assert check_counters(store, "t", CHECKS).changed_folders() == []


def test_an_interrupted_refresh_is_repeated(spark, store, table, monkeypatch):
    table([("a", "1", 5), ("b", "2", 50)])
    assert bag(reference_counts(store, "t", "part")) == [("1", 1), ("2", 1)]
    table([("c", "2", 7)])
    with monkeypatch.context() as broken:
        broken.setattr(TableStore, "_write_json", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            check_table(store, "t", CHECKS)
    assert {r["check_name"]: r["n"] for r in check_table(store, "t", CHECKS).collect()} == {"low": 2, "no_part": 0}
    # The totals are not written, though the counts they are made from are.
    with monkeypatch.context() as broken:
        broken.setattr(refcounts, "_state", lambda parts: (_ for _ in ()).throw(OSError("gone")) if len(parts) > 9 else "none")
        refcounts._counts(store, "t", "part").refresh()
    assert bag(reference_counts(store, "t", "part")) == [("1", 1), ("2", 2)]


def test_only_changed_folders_are_read(spark, store, table):
    table([(f"k{i}", str(i % 5), i) for i in range(50)])
    counters = check_counters(store, "t", CHECKS)
    counters.refresh()
    table([("k3", "3", 1000)])
    assert counters.changed_folders() == ["part=3"]
    plan = counters.rows_of(["part=3"])
    assert {path.rsplit("/", 2)[1] for path in plan.inputFiles()} == {"part=3"}
    store.overwrite(store.read("t").where("part <> '4'"), "t", ["part"])
    assert "part=4" not in {r[companion.FOLDER] for r in counters.refresh().collect()}


@pytest.mark.parametrize("keys", [["id"], ["id", "n"]])
def test_key_index_never_misses_and_skips_most(spark, store, keys):
    pick = random.Random(7)
    rows = [(f"k{pick.randrange(10**9)}", str(i % 40), i) for i in range(8000)] + [(None, "40", 1)]
    store.overwrite(spark.createDataFrame(rows, SCHEMA), "t", ["part"])
    for k in range(3):
        asked = pick.sample(rows, 5)
        batch = spark.createDataFrame(asked + [("k-none", "0", -1)], SCHEMA)
        found = folders_with(store, "t", batch, keys)
        assert {f"part={row[1]}" for row in asked} <= set(found)
        assert len(found) <= 12
    null = spark.createDataFrame([(None, "0", 1)], SCHEMA)
    assert "part=40" in folders_with(store, "t", null, keys)
    assert folders_with(store, "t", spark.createDataFrame([("a", "0", 10**6)], SCHEMA), keys) == []
    assert folders_with(store, "t", null.where("n = 5"), keys) == []


def test_moving_rows_open_only_possible_partitions(spark, store, monkeypatch):
    rows = [(f"k{i}", str(i % 30), i) for i in range(3000)]
    store.overwrite(spark.createDataFrame(rows, SCHEMA), "t", ["part"])
    opened = []
    real = companion.Companion.rows_of

    def spied(self, folders):
        opened.append((self.name, folders))
        return real(self, folders)

    monkeypatch.setattr(companion.Companion, "rows_of", spied)
    batch = spark.createDataFrame([("k7", "9", -1), ("new", "9", -2)], SCHEMA)
    save_keyed(batch, store, "t", ["id"], partition_by=["part"])
    searched = [folders for name, folders in opened if len(folders) < 30]
    assert any("part=7" in folders and len(folders) < 8 for folders in searched)
    want = [row for row in rows if row[0] != "k7"] + [("k7", "9", -1), ("new", "9", -2)]
    assert bag(store.read("t").select("id", "part", "n")) == sorted(want, key=repr)


def test_prints_find_changed_moved_and_lost_rows(spark):
    then = [(1, "a", 1), (2, "a", None), (3, "b", 1), (3, "b", 1), (4, None, 1), (5, "c", 1)]
    now = [(2, "a", None), (1, "a", 1), (3, "b", 1), (4, None, 2), (6, "d", 1)]
    by = [row_prints(spark.createDataFrame(rows, "k int, p string, v int"), ["p"], ["k", "v"]) for rows in (now, then)]
    assert bag(differing_partitions(*by, ["p"])) == sorted([("b",), (None,), ("c",), ("d",)], key=repr)


def test_tables_without_rows(spark, store):
    none = spark.createDataFrame([], SCHEMA)
    store.overwrite(none, "t", ["part"])
    assert newest(store, "t", "n") is None and heavy_keys(store, "t", "id") == []
    assert {r["n"] for r in check_table(store, "t", CHECKS).collect()} == {0}
    assert reference_counts(store, "t", "id").count() == 0
    assert folders_with(store, "t", spark.createDataFrame([("a", "p", 1)], SCHEMA), ["id"]) == []
    save_keyed(spark.createDataFrame([("a", "p", 1)], SCHEMA), store, "t", ["id"], partition_by=["part"])
    assert newest(store, "t", "n") == 1 and bag(reference_counts(store, "t", "id")) == [("a", 1)]


def test_hot_keys_from_sketches(spark, store):
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, 'hot', IF(id % 3 = 1, NULL, CAST(id AS STRING))) AS k", "id % 4 AS p")
    store.overwrite(rows, "t", ["p"])
    assert sorted(heavy_keys(store, "t", "k"), key=repr) == ["hot", None]
    store.overwrite(rows.where("k <> 'hot'"), "t", ["p"])
    assert heavy_keys(store, "t", "k") == []
    store.overwrite(rows.where("id < 0"), "t", ["p"])
    assert heavy_keys(store, "t", "k") == []


def test_unmatched_ids_of_two_tables(spark, store):
    for name, ids in (("left", "aabc"), ("right", "cdde")):
        store.overwrite(spark.createDataFrame([(i, "p") for i in ids] + [(None, "p")], "id string, part string"), name, ["part"])
    counts = unmatched_counts(reference_counts(store, "left", "id"), reference_counts(store, "right", "id"))
    assert tuple(counts.first()) == (2, 2)


@pytest.mark.parametrize("seed", range(4))
def test_closure_follows_random_edges(spark, seed):
    """Cycles, self loops, lost edges and the hop limit; each step equals a full resolve."""
    pick = random.Random(seed)
    limit = pick.choice([3, 10])
    edges = {i: pick.randrange(60) for i in pick.sample(range(60), 40)}

    def frame(pairs):
        return spark.createDataFrame(sorted(pairs.items()), "old long, new long")

    paths = walks(frame(edges), limit)
    for _ in range(3):
        before, edges = edges, dict(edges)
        for i in pick.sample(sorted(edges), 3):
            del edges[i]
        edges |= {pick.randrange(60): pick.randrange(60) for _ in range(4)}
        paths = closure.update_closure(paths, frame(before), frame(edges), limit)
        paths = spark.createDataFrame(paths.collect(), "old long, path array<long>")
        assert bag(ended_at(paths)) == bag(resolve_chain(frame(edges), limit))
    changed = closure.changed_edges(frame({1: 2}), frame({1: 2, 5: 6}))
    assert bag(changed) == [(5,)]


def test_member_prints_see_types_nulls_and_new_members(spark):
    schema = "id long, name string, n int, tags array<string>"
    then = spark.createDataFrame([(1, "a", 1, ["x"]), (2, None, 1, None), (3, "-", 1, []), (4, "d", 1, ["y"])], schema)
    now = spark.createDataFrame([(1, "a", 1, ["x"]), (2, "-", 1, None), (3, "-", 1, None), (5, "e", 1, None), (None, "f", 1, None)], schema)
    found = changed_prints(member_prints(now, "id"), member_prints(then, "id"), "id")
    assert bag(found) == bag(changed_ids(now, then, "id")) == sorted([(2,), (3,), (5,), (None,)], key=repr)
    retyped = now.withColumn("n", F.col("n").cast("long"))
    assert changed_prints(member_prints(retyped, "id"), member_prints(now, "id"), "id").count() == 5


def test_a_repeated_batch_changes_nothing(spark, store):
    first = spark.createDataFrame([("a", "p", 1), ("b", "q", 2)], SCHEMA)
    other = spark.createDataFrame([("a", "p", 9)], SCHEMA)
    save = {"keys": ["id"], "partition_by": ["part"]}
    assert save_batch(first, 0, store, "t", "s", **save) and save_batch(other, 1, store, "t", "s", **save)
    files = store.read("t").inputFiles()
    assert not save_batch(first, 0, store, "t", "s", **save) and not save_batch(other, 1, store, "t", "s", **save)
    assert store.read("t").inputFiles() == files
    assert bag(store.read("t").select("id", "part", "n")) == [("a", "p", 9), ("b", "q", 2)]


def test_stream_reads_one_folder_and_each_row_once(spark, store, tmp_path):
    sizes = []

    def seen(rows):
        sizes.append(rows.count())
        return rows

    for k in range(3):
        store.append(spark.createDataFrame([("a", "p", k), (f"b{k}", "q", k)], SCHEMA), "bronze")
        upsert_stream(store, "bronze", store, "t", ["id"], str(tmp_path / "check"), transform=seen, order_by="n")
    assert sizes == [2, 2, 2]
    assert bag(store.read("t")) == [("a", "p", 2), ("b0", "q", 0), ("b1", "q", 1), ("b2", "q", 2)]
