"""Toxicity field and domain mixing."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm.mixing import copies, fit_domains, fit_steps, mixed, rates
from lakemart.llm.toxic_crf import _log_odds, _spans, toxicity, train


def test_log_odds_are_those_of_all_paths():
    pick = np.random.default_rng(1)
    lengths = np.array([3, 1, 6, 2])
    emission = pick.normal(size=lengths.sum())
    transitions = pick.normal(size=(2, 2))
    got = np.split(_log_odds(emission, lengths, transitions), np.cumsum(lengths)[:-1])
    for part, odds in zip(np.split(emission, np.cumsum(lengths)[:-1]), got):
        mass = np.zeros((len(part), 2))
        for path in itertools.product((0, 1), repeat=len(part)):
            weight = np.exp(
                sum(part[i] for i, state in enumerate(path) if state)
                + sum(transitions[a, b] for a, b in zip(path, path[1:]))
            )
            for i, state in enumerate(path):
                mass[i, state] += weight
        assert np.allclose(odds, np.log(mass[:, 1] / mass[:, 0]))


def labelled(n, seed):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{pick.randrange(400)}" for _ in range(pick.randint(5, 60))]
        toxic = int(pick.random() < 0.3)
        for _ in range(3 * toxic):
            mark = pick.choice(["nasty", f"grubl{pick.choice('aeiou')}{pick.randrange(99)}"])
            words.insert(pick.randrange(len(words)), mark + pick.choice(["", ",", "."]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxic_documents_and_spans(spark):
    rows = labelled(900, 3)
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    known = [(i, toxic) for i, _, toxic in rows if i < 600]
    labels = spark.createDataFrame([*known, (None, 1), (3, None)], "doc_id long, toxic int")
    model = train(docs, labels)
    more = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "w1 " * 50000), (-4, "w1 nasty, w2")], "doc_id long, text string"
    ).withColumn("score", F.lit("old"))
    found = docs.withColumn("score", F.lit("old")).unionAll(more)
    found = {row[0]: row[1] for row in found.select("doc_id", toxicity(F.col("text"), model)).collect()}
    right = [(found[i]["score"] >= 0.5) == bool(toxic) for i, _, toxic in rows if i >= 600]
    assert np.mean(right) > 0.97
    assert found[-1]["score"] == found[-2]["score"] < 0.5 and found[-3]["score"] < 0.5
    assert found[-4]["score"] >= 0.5
    assert [(s["start"], s["end"]) for s in found[-4]["spans"]] == [(3, 9)]


def test_no_labels_give_the_share(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scores = docs.select(toxicity(F.col("text"), train(docs, labels))["score"]).collect()
    assert scores[0][0] == scores[1][0] == 0.5
    assert docs.where("doc_id < 0").select(toxicity(F.col("text"), train(docs, labels))).count() == 0


def test_spans_are_offsets_of_tokens():
    assert _spans(" a  bad\nword x", np.array([-1.0, 2.0, 3.0, -2.0])) == [
        {"start": 4, "end": 12, "log_odds": 3.0}
    ]
    assert _spans("", np.zeros(0)) == []


def quality_rows(n, seed):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{pick.choice(['plain', 'word', 'other'])}{pick.randrange(300)}" for _ in range(40)]
        poor = i % 4 == 0
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if poor else " ".join(words), poor))
    return rows


def test_mix_meets_its_shares(spark):
    rows = quality_rows(400, 1)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (900, "")], "doc_id long, text string")
    docs = docs.withColumn("rate", F.lit("old"))
    labels = spark.createDataFrame(
        [(i, "poor" if poor else "good") for i, _, poor in rows[:300]] + [(None, "good"), (399, None)],
        "doc_id long, domain string",
    )
    domains = fit_domains(docs, labels, ["good", "poor"])
    members = domains.posteriors(docs)
    found = rates(members, fit_steps(members, [0.9, 0.1])).collect()
    totals = np.zeros(2)
    for row in found:
        assert row["rate"] >= 0 and abs(sum(row["_p"]) - 1) < 1e-9
        totals += row["rate"] * row["_n"] * np.array(row["_p"])
    assert abs(totals[0] / totals.sum() - 0.9) < 1e-4
    right = [(row["_p"][1] > 0.5) == rows[row["doc_id"]][2] for row in found if (row["doc_id"] or 900) < 400]
    assert np.mean(right) > 0.99
    kept = mixed(docs, domains, [0.9, 0.1])
    assert kept.columns == docs.columns
    good = {row["doc_id"] for row in kept.collect()}
    assert len([1 for i, _, poor in rows if not poor and i in good]) >= 290
    assert mixed(docs.where("doc_id < 0"), domains, [0.9, 0.1]).count() == 0


def test_mix_without_labels_keeps_shares_even(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, domain string")
    domains = fit_domains(docs, labels, ["good", "poor"])
    found = rates(domains.posteriors(docs), fit_steps(domains.posteriors(docs), [0.5, 0.5])).collect()
    assert [row["_p"] for row in found] == [[0.5, 0.5]] * 3
    assert all(abs(row["rate"] - 1) < 1e-6 for row in found)


def test_copies_are_the_rate_on_average(spark):
    rows = spark.range(20000).select(copies(F.lit(1.25), F.col("id")).alias("n"))
    assert abs(rows.agg(F.avg("n")).first()[0] - 1.25) < 0.02
    assert {row["n"] for row in rows.distinct().collect()} == {1, 2}
