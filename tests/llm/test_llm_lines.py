"""Whole lines that repeat, and rows without an id of their own."""

import random

from pyspark.sql import functions as F

from lakemart.llm.line_dedup import dedup_lines


def cut(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((row["doc_id"] is None, row["doc_id"] or 0, row["text"]) for row in dedup_lines(docs).collect()), key=repr)


def test_short_lines_go_whatever_their_length(spark):
    rows = [
        (1, "All rights reserved.\nfirst of its own"),
        (2, "second of its own\nall rights RESERVED\nHome\nand more here"),
        (3, "Home\n\nall rights reserved"),
        (4, "before all rights reserved behind"),
        (5, "tiny"),
        (6, "tiny"),
        (7, "x y\nz\nx y\n"),
    ]
    assert [text for _, _, text in cut(spark, rows)] == [
        rows[0][1],
        "second of its own\nHome\nand more here",
        "",
        rows[3][1],
        "tiny",
        "",
        "x y\nz",
    ]


def test_lines_against_brute_force(spark):
    pick = random.Random(3)
    pool = [" ".join(f"w{pick.randrange(10**6)}" for _ in range(pick.randint(1, 12))) for _ in range(60)]
    rows = [(i, "\n".join(pick.choice(pool) for _ in range(pick.randint(1, 8)))) for i in range(80)]
    seen, want = set(), []
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            if line not in seen:
                kept.append(line)
            seen.add(line)
        want.append((False, i, "\n".join(kept)))
    assert cut(spark, rows) == sorted(want, key=repr)


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(f"{pick.choice('abcdefgh')}{pick.randrange(5000)}" for _ in range(n))


def test_rows_without_id_repeat_each_other(spark):
    copy, passage = prose(1, 40), prose(2, 80)
    rows = [(None, copy)] * 3 + [(None, f"{prose(3, 20)} {passage} {prose(4, 20)}")]
    rows += [(None, f"{prose(5, 20)} {passage} {prose(6, 20)}"), (1, "with an id"), (None, "with an id"), (None, None)]
    for got in (cut(spark, rows), cut(spark, rows[::-1])):
        texts = [text for nameless, _, text in got if nameless]
        assert sorted(text for text in texts if text == copy) == [copy] and texts.count("") == 3
        assert texts.count(None) == 1 and len(got) == len(rows)
        sizes = sorted(len(text.split()) for text in texts if text and text != copy)
        assert sizes[1] == 120 and 40 <= sizes[0] <= 70
        assert (False, 1, "with an id") in got
    assert cut(spark, rows) == cut(spark, rows[::-1])


def test_lists_are_bounded_by_one_text(spark, monkeypatch):
    """The rows of one id, or without any, each get only what their own text repeats."""

    def size(text, earlier, least):
        return F.struct(F.size(earlier).alias("text"), F.lit(0).alias("removed"))

    monkeypatch.setattr("lakemart.llm.line_dedup._cut", size)
    for doc_id in (None, 9):
        rows = [(1, "\n".join(f"line number {i}" for i in range(200)))]
        rows += [(doc_id, f"line number {i}") for i in range(200)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert 1 <= dedup_lines(docs).agg(F.max("text")).first()[0] <= 3
