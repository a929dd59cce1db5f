"""Fingerprints of documents against a plain version, and likeness against the true similarity."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakemart.llm import bin_minhash as m
from lakemart.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BINS = 1 << m.BIN_BITS
MASK = (1 << 64) - 1


def h_long(value, seed=42):
    return xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def shingle_set(text):
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", text.lower()) if w]
    size = m.SHINGLE
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, bool(words)))}


def plain_print(text, probe):
    """Bins by their smallest hash; empty ones by the first bin of their order that isn't empty."""
    hashes = []
    for shingle in shingle_set(text):
        each = [xxhash.xxh64_intdigest(w.encode(), 42) for w in shingle]
        if len(each) < m.SHINGLE:
            hashes.append(xxhash.xxh64_intdigest(" ".join(str(signed(x)) for x in each).encode(), 42))
            continue
        own = 42
        for x in each:
            own = h_long(x, own)
        hashes.append(own)
    if not hashes:
        return ""
    least = {}
    for x in sorted(hashes, key=signed, reverse=True):
        least[x >> (64 - m.BIN_BITS) ^ BINS // 2] = x
    out = [least.get(b, least[next(o for o in probe[b] if o in least)]) for b in range(BINS)]
    low = (1 << m.KEPT_BITS) - 1
    return "".join(f"{x & low:0{m.KEPT_BITS // 4}x}" for x in out)


@pytest.fixture(scope="module")
def probe(spark):
    b = F.col("id").cast("int")
    found = spark.range(BINS).select("id", F.array(*(m._other(b, k) for k in range(BINS))).alias("o")).collect()
    orders = {row["id"]: list(row["o"]) for row in found}
    assert all(sorted(order) == list(range(BINS)) for order in orders.values())
    return orders


def texts_of(folder):
    import duckdb

    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{folder}/documents.parquet'").fetchall())


def test_op13_over_documents(spark, probe):
    docs = texts_of(FOLDER)
    order = sorted(docs, reverse=True)
    rows = {row["doc_id"]: row for row in QUERIES["op13_bin_minhash"](spark, FOLDER).collect()}
    assert set(rows) == set(docs)
    errors = []
    for at, i in enumerate(order):
        text, following = docs[i], docs[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == plain_print(text, probe)
        assert row["edited_fingerprint"] == plain_print(edited, probe)
        for other, name in ((edited, "near_edited"), (following, "near_next")):
            a, b = shingle_set(text), shingle_set(other)
            errors.append(row[name] - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05 and np.max(np.abs(errors)) < 0.25


@pytest.mark.parametrize("n", [1, 2, 5, 12, 60, 300])
def test_likeness_of_short_and_long_texts(spark, probe, n):
    """Few shingles leave most bins empty: densified bins must still estimate the similarity."""
    pick = random.Random(n)
    rows = []
    for k in range(150):
        words = [f"w{pick.randrange(10**6)}" for _ in range(n + 4)]
        cut = pick.randrange(n + 4)
        rows.append((" ".join(words), " ".join(words[:cut] + [f"x{i}" for i in range(n + 4 - cut)])))
    docs = spark.createDataFrame(rows, "a string, b string")
    prints = docs.select("a", "b", m.fingerprint(F.col("a")).alias("p"), m.fingerprint(F.col("b")).alias("q"))
    found = prints.select("a", "b", m.as_text(F.col("p")), m.likeness(F.col("p"), F.col("q")), m.likeness(F.col("p"), F.col("p")))
    errors = []
    for a, b, digits, near, same in found.collect():
        assert digits == plain_print(a, probe) and same == 1.0
        s, t = shingle_set(a), shingle_set(b)
        errors.append(near - len(s & t) / len(s | t))
    assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.2


def edited(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int, copies int")
    places = m.neighbours(docs)
    most = places.agg(F.max("n")).first()[0] or 0
    found = m.edited_pairs(docs, places).select("id", "edited", m.as_text(F.col("prints")), m.likeness(F.col("prints"), F.col("next_prints")), "copies")
    return [tuple(row) for row in m.repeated(found, "copies", most).collect()]


def test_nulls_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(m, "COPIES", 3)
    rows = [(5, "abcd efgh", 1, 1)] * 8 + [(4, "ABCDEFGH" * 4, 1, 1), (3, None, 1, 1), (None, "", 1, 1), (None, "xyz", 1, 1)]
    found = edited(spark, rows)
    assert len(found) == len(rows)
    texts = sorted(row[1] for row in found if row[0] == 5)
    assert texts == ["abcd ABCD"] + ["abcd abcd"] * 7
    by_id = {row[0]: row for row in found if row[0] in (3, 4)}
    assert by_id[3][1:3] == ("", "") and by_id[4][1] == "ABCDEFGH" * 2
    assert {row[3] for row in found if row[0] == 5} == {0.0, 1.0}
    assert sorted(row[2] == "" for row in found if row[0] is None) == [False, True]


def test_one_row_and_none(spark):
    assert edited(spark, []) == []
    assert [row[1] for row in edited(spark, [(1, "one two", 0, 0)])] == ["one one"]
