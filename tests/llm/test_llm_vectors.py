"""Vector search and near-duplicates against brute force."""

import numpy as np
import pytest

from lakemart.llm.dimension_scan import scan, search
from lakemart.llm.pivot_index import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(90001, None, 1), (90002, [0.0] * 16, 1), (90003, [float("nan")] + [1.0] * 15, 1), (90004, [], 2)]
BAD += [(90005, [float("inf")] * 16, 1), (90006, [None] + [1.0] * 15, 1), (None, [1.0] * 16, 1)]


def vectors(n, seed):
    pick = np.random.default_rng(seed)
    rows = pick.normal(size=(n, 16)).astype(np.float32)
    for i in range(n // 5, n // 3):
        # Near copies of some rows, and equal ones of others.
        rows[i] = rows[i % 17] + (pick.normal(size=16) * 0.08 if i % 3 else 0)
    return rows, pick.integers(0, 3, n)


def test_search_finds_the_nearest(spark):
    rows, _ = vectors(3000, 1)
    table = spark.createDataFrame([(i, row.tolist(), 0) for i, row in enumerate(rows)] + BAD, SCHEMA)
    table = table.unionAll(table.where("vec_id = 40"))
    found = search(table, table.where("vec_id % 50 = 0"), "vec_id", "embedding", k=5)
    got = {}
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    exact = rows.astype(np.float64) @ rows.astype(np.float64).T
    hits = 0
    assert set(got) == set(range(0, 3000, 50))
    for q, answer in got.items():
        order = sorted((i for i in range(3000) if i != q), key=lambda i: (-exact[q, i], i))[:5]
        hits += len(set(order) & {v for _, v, _ in answer})
        assert [rank for rank, _, _ in answer] == [1, 2, 3, 4, 5]
        assert all(abs(score - exact[q, v]) < 1e-9 for _, v, score in answer)
    assert hits >= 0.9 * 5 * len(got)


def test_search_in_few_rows_and_ties(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 2.0], 0), (4, [1.0], 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = search(table, table.where("vec_id = 0"), "vec_id", "embedding", k=20).orderBy("rank").collect()
    assert [(row["vec_id"], row["score"]) for row in found] == [(1, 1.0), (2, 1.0), (3, 0.0)]
    empty = table.where("vec_id < 0")
    assert search(empty, empty, "vec_id", "embedding").count() == 0
    assert search(table, empty, "vec_id", "embedding").count() == 0


def test_scan_keeps_what_is_within_bounds():
    pick = np.random.default_rng(3)
    asked, rows = pick.normal(size=(20, 65)), pick.normal(size=(400, 65))
    square = ((asked[:, None] - rows) ** 2).sum(axis=2)
    bound = np.sort(square, axis=1)[:, 9]
    ask, hit = scan(asked, rows, bound + 1e-9)
    true = set(zip(*np.nonzero(square <= bound[:, None])))
    assert len(true & set(zip(ask, hit))) >= 0.97 * len(true)
    assert all(square[a, h] <= bound[a] + 1e-6 for a, h in zip(ask, hit))


@pytest.mark.parametrize("block", [1024, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr("lakemart.llm.meeting.INDEX_BLOCK", block)
    monkeypatch.setattr("lakemart.llm.meeting.QUERY_BLOCK", 2 * block)
    rows, labels = vectors(900, 2)
    table = spark.createDataFrame(
        [(i, row.tolist(), int(label)) for i, (row, label) in enumerate(zip(rows, labels))]
        + [(5000, rows[0].tolist(), None)]
        + BAD,
        SCHEMA,
    )
    found = {row["vec_id"]: row for row in near_duplicates(table, "vec_id", "embedding", "label").collect()}
    exact = rows.astype(np.float64)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    near = (exact @ exact.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    got = np.array([found[i]["n_links"] for i in range(900)])
    assert (got <= near.sum(axis=1)).all() and got.sum() >= 0.95 * near.sum() and got.sum() % 2 == 0
    root = np.arange(900)
    for _ in range(40):
        root = np.array([min(root[i], root[near[i]].min(initial=i)) for i in range(900)])
    assert np.mean([found[i]["component_id"] == root[i] for i in range(900)]) > 0.98
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(900))
    for i in [5000, *(row[0] for row in BAD)]:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert len(found) == 900 + 1 + len(BAD)


def test_equal_vectors_are_linked_and_nothing_links_in_an_empty_table(spark):
    rows = [(3, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 2), (3, [1.0, 1.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates(table, "vec_id", "embedding", "label").orderBy("vec_id").collect()
    assert [tuple(row) for row in got] == [(1, 2, 1, True), (2, 0, 2, True), (3, 2, 1, False), (3, 2, 1, False)]
    assert near_duplicates(table.where("vec_id < 0"), "vec_id", "embedding", "label").count() == 0
