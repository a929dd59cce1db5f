"""Stray vectors, repeated ids, targets out of reach."""

import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm.dimension_scan import search
from lakemart.llm.mixing import fit_steps, rate_of, _cell
from lakemart.llm.pivot_index import near_duplicates
from lakemart.llm.toxic_crf import train

VECTORS = "vec_id long, embedding array<float>, label int"


def test_two_near_vectors_alone_are_linked(spark):
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, [1.0, 0.01, 0.0], 1)]
    found = near_duplicates(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", "label").collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(1, 1, 1), (2, 1, 1)]


@pytest.mark.parametrize("stray", range(6))
def test_a_stray_length_takes_no_regular_vector_out(spark, stray):
    pick = np.random.default_rng(stray)
    rows = [(i, pick.normal(size=8).tolist(), 1) for i in range(40)] + [(100 + stray, [1.0, 2.0], 1)]
    rows.append((41, rows[7][1], 1))
    table = spark.createDataFrame(rows, VECTORS)
    found = search(table, table.where("vec_id in (0, 20)"), "vec_id", "embedding", k=5)
    assert found.groupBy("query_id").count().collect() and found.count() == 10
    linked = near_duplicates(table, "vec_id", "embedding", "label").where("n_links > 0")
    assert {7, 41} <= {r["vec_id"] for r in linked.collect()}


def test_search_without_help_of_the_sample(spark, monkeypatch):
    """The lists themselves find the nearest: a sample of 256 rows holds few of them."""
    monkeypatch.setattr("lakemart.llm.dimension_scan.SAMPLE", 256)
    pick = np.random.default_rng(5)
    rows = pick.normal(size=(6000, 16)).astype(np.float32)
    table = spark.createDataFrame([(i, row.tolist(), 0) for i, row in enumerate(rows)], VECTORS)
    found = search(table, table.where("vec_id % 100 = 0"), "vec_id", "embedding", k=10).collect()
    exact = rows.astype(np.float64) @ rows.astype(np.float64).T
    hits = 0
    for q in range(0, 6000, 100):
        order = [i for i in np.argsort(-exact[q], kind="stable") if i != q][:10]
        hits += len(set(order) & {r["vec_id"] for r in found if r["query_id"] == q})
    assert len(found) == 600 and hits >= 0.9 * 600


def test_one_id_on_very_many_rows_is_one_text_of_the_fit(spark):
    docs = spark.range(3000).selectExpr("IF(id < 2900, 7L, id) AS doc_id", "concat('fine words ', id) AS text")
    labels = spark.range(2890, 3000).selectExpr("IF(id < 2900, 7L, id) AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    seen = []
    import lakemart.llm.toxic_crf as crf

    real = crf.cut_lineage
    crf.cut_lineage = lambda df, label: seen.append(real(df, label)) or seen[-1]
    try:
        train(docs, labels)
    finally:
        crf.cut_lineage = real
    assert seen[0].count() == 101


def members(spark, posteriors, words=100):
    rows = [(words, [float(p), 1 - float(p)]) for p in posteriors]
    return spark.createDataFrame(rows, "_n long, _p array<double>")


def totals(table, steps):
    rate = rate_of(_cell(F.col("_p")), steps)
    row = table.agg(*(F.sum(rate * F.col("_n") * F.col("_p")[k]) for k in (0, 1)), F.min(rate), F.avg(rate)).first()
    return [float(x) for x in row]


@pytest.mark.parametrize("pool, share", [(0.8, 0.92), (0.86, 0.95), (0.8, 0.95)])
def test_far_targets_are_reached(spark, pool, share):
    pick = np.random.default_rng(3)
    table = members(spark, pick.beta(4 * pool, 4 * (1 - pool), size=3000))
    good, poor, least, _ = totals(table, fit_steps(table, [share, 1 - share]))
    assert least >= 0 and abs(good / (good + poor) - share) < 1e-4


def test_rates_are_the_least_squares(spark):
    """Against a plain projected solution of: rates nearest to 1 whose totals are the targets."""
    pick = np.random.default_rng(8)
    p = np.round(pick.beta(2, 1, size=400) * 64) / 64
    table = members(spark, p)
    steps = fit_steps(table, [0.9, 0.1])
    got = np.array([r[0] for r in table.select(rate_of(_cell(F.col("_p")), steps)).collect()])
    design = np.stack([p, 1 - p])
    target = design @ got
    # Optimal: the rate is max(0, 1 - p.l) for one vector l, and no rate is below 0.
    positive = got > 1e-9
    solved = np.linalg.lstsq(design[:, positive].T, 1 - got[positive], rcond=None)[0]
    assert np.allclose(np.maximum(0, 1 - design.T @ solved), got, atol=1e-6)
    assert abs(target[0] / target.sum() - 0.9) < 1e-4


def test_an_absent_domain_is_reported_and_empties_nothing(spark, caplog):
    table = members(spark, [1.0] * 50)
    with caplog.at_level(logging.WARNING):
        steps = fit_steps(table, [0.92, 0.08])
    assert "wanted domains" in caplog.text and totals(table, steps)[3] == 1.0
    with caplog.at_level(logging.WARNING):
        fit_steps(members(spark, [0.5] * 50), [0.92, 0.08])
    assert "misses its targets" in caplog.text
