"""The search on tables of many blocks, and on copies of vectors."""

import numpy as np
import pytest

from lakemart.llm import dimension_scan
from lakemart.llm.dimension_scan import scan, search

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def cuts(monkeypatch):
    """Tables that a search has written, by their labels."""
    seen, real = {}, dimension_scan.cut_lineage

    def cut(df, label):
        seen.setdefault(label, []).append(real(df, label))
        return seen[label][-1]

    monkeypatch.setattr(dimension_scan, "cut_lineage", cut)
    return seen


def table_of(spark, ids, rows):
    return spark.createDataFrame([(int(i), row.tolist(), 0) for i, row in zip(ids, rows)], SCHEMA)


def found_in(spark, ids, rows, every, k):
    table = table_of(spark, ids, rows)
    found = search(table, table.where(f"vec_id % {every} = 0"), "vec_id", "embedding", k=k)
    return {tuple(row) for row in found.collect()}


def test_few_rows_are_written_for_a_query(spark, monkeypatch, cuts):
    """Not all rows within the bound of the sample, which are a share of the table."""
    monkeypatch.setattr(dimension_scan, "SAMPLE", 256)
    pick = np.random.default_rng(5)
    rows = pick.normal(size=(6000, 16)).astype(np.float32)
    whole = found_in(spark, range(6000), rows, 20, 10)
    # 6 blocks, 10 others and itself.
    assert len(whole) == 3000
    assert sum(found.count() for found in cuts["found"]) <= 300 * 6 * 11
    cuts.clear()
    monkeypatch.setattr(dimension_scan, "HELD", 128)
    monkeypatch.setattr(dimension_scan, "MOST", 128)
    monkeypatch.setattr(dimension_scan, "ASKED", 100)
    assert found_in(spark, range(6000), rows, 20, 10) == whole
    ahead, others = (found.count() for found in cuts["found"])
    # 47 blocks, of which 6 are searched first; the others have few rows that are better.
    assert ahead <= 300 * 6 * 11 and others <= 300 * 10 * 11


def test_copies_are_scanned_once(spark, cuts):
    pick = np.random.default_rng(6)
    rows = np.tile(pick.normal(size=(60, 8)).astype(np.float32), (40, 1))
    ids = np.arange(2400)
    found = found_in(spark, ids, rows, 100, 20)
    assert cuts["entries"][0].count() == 60
    exact = rows.astype(np.float64) @ rows.astype(np.float64).T
    want = set()
    for q in range(0, 2400, 100):
        order = np.lexsort((ids, -exact[q]))
        want |= {(q, rank, int(v)) for rank, v in enumerate(order[order != q][:20], 1)}
    assert {row[:3] for row in found} == want
    assert all(score == pytest.approx(exact[q, v], abs=1e-9) for q, _, v, score in found)


@pytest.mark.parametrize("held", [1 << 14, 64])
def test_an_id_of_several_vectors_is_one_answer(spark, monkeypatch, held):
    monkeypatch.setattr(dimension_scan, "SAMPLE", 128)
    monkeypatch.setattr(dimension_scan, "HELD", held)
    monkeypatch.setattr(dimension_scan, "MOST", held)
    pick = np.random.default_rng(7)
    rows = pick.normal(size=(1500, 8)).astype(np.float32)
    rows[100:130] = rows[0] * pick.uniform(1.1, 1.9, 30)[:, None]
    ids = np.arange(1500)
    ids[100:130] = 5000
    found = {row[2]: row for row in found_in(spark, ids, rows, 5001, 10)}
    exact = rows.astype(np.float64) @ rows[0].astype(np.float64)
    best = {}
    for i, score in zip(ids.tolist(), exact):
        best[i] = max(score, best.get(i, score))
    order = sorted((i for i in best if i), key=lambda i: (-best[i], i))[:10]
    assert 5000 in found and len(found) == 10 and len(set(order) & set(found)) >= 9
    assert found[5000][1] == 1 and found[5000][3] == pytest.approx(best[5000])


def test_scan_tests_whole_distances_by_the_last_bound():
    pick = np.random.default_rng(4)
    asked, rows = pick.normal(size=(30, 33)), pick.normal(size=(300, 33))
    square = ((asked[:, None] - rows) ** 2).sum(axis=2)
    bound, last = np.sort(square, axis=1)[:, 60], np.sort(square, axis=1)[:, 9]
    loose, tight = (set(zip(*scan(asked, rows, bound, x))) for x in (bound, last + 1e-9))
    assert tight == {(a, h) for a, h in loose if square[a, h] <= last[a] + 1e-9}
