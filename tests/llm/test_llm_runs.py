"""Periodic runs against a brute-force search of all periods."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm.periodic_runs import numbered, periodic_runs, runs_of
from lakemart.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain_runs(words):
    """(start, length, period): for each period the longest stretches that keep it, smallest period only."""
    ids = np.array([hash(w) for w in words])
    found = {}
    for q in range(1, len(words) // 3 + 1):
        same = np.r_[False, ids[q:] == ids[:-q], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(24, 3 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((a, n, q) for (a, n), q in found.items())


def found_runs(words):
    flat, _ = numbered([words])
    start, end, period = periodic_runs(flat, len(words))
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist()))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("seed", range(40))
def test_runs_in_made_sequences(seed):
    pick = random.Random(seed)
    words = []
    while len(words) < 900:
        base = [str(pick.randrange(pick.choice([1, 2, 3, 50]))) for _ in range(pick.choice([1, 2, 3, 7, 15, 16, 17, 31, 40, 64, 90]))]
        if pick.random() < 0.3:
            base = base[:3] * pick.randint(2, 9) + base
        words += (base * 9)[: pick.choice([len(base), 3 * len(base), 3 * len(base) + 1, 5 * len(base), 9 * len(base)])]
    assert found_runs([w.encode() for w in words]) == plain_runs(words)


@pytest.mark.parametrize("words", [[], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 500, fibonacci(900), list("ab") * 12])
def test_runs_in_extreme_sequences(words):
    assert found_runs([w.encode() for w in words]) == plain_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(3, 6), st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_any_period(period, times, rest):
    words = [str(w).encode() for w in rest[:20] + period * times + period[: len(period) // 2] + rest]
    assert found_runs(words) == plain_runs(words)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_op12_over_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_synchronising_runs"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(expected(*row) for row in docs)
    assert sum(row["n_runs"] > 0 for row in rows) > 5


def test_nulls_repeated_rows_and_a_very_long_text(spark, monkeypatch):
    long = " ".join(f"w{i % 5000}" for i in range(170_000))
    rows = [(None, "a " * 30), (10, None), (10, ""), (10, " \t\n"), (7, "a " * 30), (7, "a " * 30), (8, long)]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, runs int")
    found = docs.select("doc_id", "text", runs_of(F.col("text")).alias("found")).collect()
    for doc_id, text, one in found:
        want = plain_runs((text or "").encode().split()) if text != long else [(0, 170_000, 5000)]
        assert [tuple(run) for run in one["runs"]] == want
        assert one["best"] == (0 if want else None)
    assert docs.where("doc_id = -1").select(runs_of(F.col("text"))).count() == 0


def test_only_ascii_white_space_ends_a_word(spark):
    docs = spark.createDataFrame([("a\u00a0b\u2003c d\x0b" * 14,)], "text string")
    one = docs.select(runs_of(F.col("text")).alias("found")).first()["found"]
    assert [tuple(run) for run in one["runs"]] == [(0, 28, 2)]
