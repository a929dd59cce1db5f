"""Near copies of texts against brute-force Jaccard similarity."""

import os
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_dedup import groups_of

from lakemart.llm import near_text
from lakemart.llm.near_text import keep_one, matches, print_of, shingle_set, table_plan

FOLDER = os.environ.get("TEST_NEAR_DIR", "/root/testdata/sf0.01")


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, bool(words))))


def near_pairs(texts):
    """Indices of texts that share 0.8 of their shingles, or have none at all."""
    sets, where = [plain_set(text) for text in texts], {}
    found = set(combinations([i for i, s in enumerate(sets) if not s], 2))
    for i, s in enumerate(sets):
        common = {}
        for shingle in s:
            for j in where.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            where[shingle].append(i)
        found |= {(j, i) for j, n in common.items() if 5 * n >= 4 * (len(s) + len(sets[j]) - n)}
    return found


def edited(words, share, pick):
    """A copy whose words are replaced one by one until its similarity is just above ``share``."""
    whole, last = plain_set(" ".join(words)), list(words)
    while True:
        tried = list(last)
        tried[pick.randrange(len(tried))] = f"new{pick.randrange(10**6)}"
        other = plain_set(" ".join(tried))
        if len(whole & other) / len(whole | other) < share:
            return last
        last = tried


def judged(rows, got):
    """Rows that brute force drops, and those of them that stay though they should go."""
    ids = [i for i, _ in rows]
    roots = groups_of([(ids[a], ids[b]) for a, b in near_pairs([text for _, text in rows])], ids)
    firsts = set(roots.values())
    assert firsts <= got, "a document went that is no near copy of another one"
    return set(ids) - firsts, got - firsts


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    gone, missed = judged(rows, {row["doc_id"] for row in kept.collect()})
    assert gone and len(missed) <= 0.05 * len(gone)


@pytest.mark.parametrize("sizes", [(512, 1024, 2e8), (16, 40, 2e4)])
def test_made_copies(spark, monkeypatch, sizes):
    """Copies of 0.8 and more of many texts; with small shards and parts, too."""
    for name, size in zip(("SHARD_MEAN", "SHARD_PART", "PART_COST"), sizes):
        monkeypatch.setattr(near_text, name, size)
    pick = random.Random(11)
    rows = []
    for _ in range(80):
        words = [f"w{pick.randrange(3000)}" for _ in range(pick.randint(30, 300))]
        rows += [" ".join(t) for t in [words, *(edited(words, s, pick) for s in (0.6, 0.78, 0.8, 0.8, 0.85, 0.9))]]
    rows += ["one two", "One  TWO", "one three", "", None, " \n"]
    table = list(zip(pick.sample(range(10**6), len(rows)), rows))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    gone, missed = judged(table, {row["doc_id"] for row in keep_one(docs).collect()})
    assert len(gone) > 250 and len(missed) <= 0.05 * len(gone)


def test_a_third_of_the_rows_is_one_group(spark, monkeypatch):
    monkeypatch.setattr(near_text, "SHARD_PART", 64)
    monkeypatch.setattr(near_text, "PART_COST", 1e6)
    pick = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(edited(base, 0.88, pick)) for _ in range(500)]
    # These are near the base, but not near most of its copies.
    texts += [" ".join(edited(base, 0.81, pick)) for _ in range(20)]
    texts += [" ".join(f"x{pick.randrange(10**5)}" for _ in range(80)) for _ in range(1000)]
    table = list(enumerate([" ".join(base), *texts]))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    gone, missed = judged(table, {row["doc_id"] for row in keep_one(docs).collect()})
    assert len(gone) == 520 and len(missed) <= 2


def test_very_long_texts(spark):
    pick = random.Random(2)
    words = [f"w{pick.randrange(10**6)}" for _ in range(140_000)]
    long = [" ".join(words), " ".join(words[:70_000] + ["other"] + words[70_001:]), " ".join(words[::-1])]
    docs = spark.createDataFrame(list(enumerate(long * 2)), "doc_id long, text string")
    assert sorted(row["doc_id"] for row in keep_one(docs).collect()) == [0, 2]


def test_clashing_columns_nulls_and_repeated_rows(spark):
    words = [f"w{i}" for i in range(100)]
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words)), (None, near), (None, "alone here"), (3, "first text"), (3, "second text")]
    rows += [(2, near.upper() + " x"), (2, near.upper() + " x"), (9, "repeated"), (9, "repeated")]
    names = "key, node, root, th, rh, kt, n, grp, part, print, found"
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", *(f"doc_id AS {name.strip()}" for name in names.split(",")), "map('a', doc_id) AS m", "1 AS `a.b`"
    )
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((row["doc_id"] or 0, row["text"]) for row in kept.collect())
    assert got == [(0, "alone here"), (2, near.upper() + " x"), (3, "first text"), (3, "second text"), (9, "repeated")]
    assert keep_one(docs.where("doc_id < 0")).count() == 0


def test_prints_of_the_least_similarity():
    """The radius and the number of tables follow from how many bits differ there."""
    pick = random.Random(4)
    apart = []
    for _ in range(200):
        words = [f"w{pick.randrange(10**6)}" for _ in range(pick.randint(60, 400))]
        a, b = (print_of(shingle_set(" ".join(t).encode())) for t in (words, edited(words, 0.8, pick)))
        apart.append(np.bitwise_count(a ^ b))
    apart = np.array(apart)
    assert abs(apart.mean() / 64 - near_text.DIFFERING) < 0.02
    near = (apart[:, 0] <= near_text.RADIUS) & (apart[:, :2].sum(axis=1) <= near_text.CONFIRMED)
    assert near.mean() > 0.97
    assert [table_plan(n)[0] for n in (0, 512, 513, 512 << 10)] == [0, 0, 1, 10]
    assert table_plan(512 << 10)[1] > table_plan(512 << 5)[1]


def test_matches_take_the_limit_itself():
    sets = [np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64), np.arange(2, 11, dtype=np.uint64)]
    found = {(int(q), int(i)) for rows, others in matches(sets) for q, i in zip(rows, others) if q < i}
    assert found == {(0, 1), (1, 2)}
