"""The nested manifest against a plain tree built with hashlib."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lakemart.llm.manifest import folded, manifest, proof

COLUMNS = ["doc_id", "source", "text"]
SCHEMA = "doc_id long, source string, text string, item int, grp string, `rank` int, size int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(nodes):
    """Root of a list of hashes, and the siblings of each leaf as (left, right) by level."""
    paths = [[] for _ in nodes]
    owner = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for k in run:
                sides = ("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k))
                for leaf in owner[k]:
                    paths[leaf].append(sides)
        nodes = [h(*(nodes[k] for k in run)) for run in runs]
        owner = [[leaf for k in run for leaf in owner[k]] for run in runs]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        kept = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, h(framed(r))))
        built[source] = (kept, *tree([h(framed(r)) for r in kept]))
    root, above = tree([built[source][1] for source in order])
    out = []
    for source, up in zip(order, above):
        kept, subroot, paths = built[source]
        for row, path in zip(kept, paths):
            whole = [*path, *up]
            out.append((source, row[0], h(framed(row)), subroot, root, h(*(a + b for a, b in whole))))
    return out


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def found_rows(docs):
    found = manifest(docs, "source", "doc_id", COLUMNS, {"other": F.upper("text")})
    checked = found.select(
        "source",
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof(F.col("path")), 256),
        folded(F.col("leaf"), F.col("path")).alias("folded"),
        "other",
    ).collect()
    assert all(row["folded"] == row["root"] for row in checked)
    return [tuple(row)[:6] for row in checked]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 17, None: 3, "": 16, "é": 1, "z": 257}, {"hot": 4098, "b": 2}])
def test_manifest_is_the_plain_tree(spark, sizes):
    pick = random.Random(3)
    ids = pick.sample(range(-9999, 10**6), sum(sizes.values()))
    rows = [(ids.pop(), source, f"Text {i}\n é" * (i % 3)) for source, n in sizes.items() for i in range(n)]
    pick.shuffle(rows)
    docs = spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], SCHEMA)
    assert sorted(found_rows(docs), key=key) == sorted(plain(rows), key=key)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, "a", "x"), (None, "a", None), (5, "a", "x"), (5, "a", "y"), (5, "a", "y"), (5, None, "")]
    rows += [(7, "b", "same")] * 40
    docs = spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], SCHEMA)
    assert sorted(found_rows(docs), key=key) == sorted(plain(rows), key=key)


def test_empty_table(spark):
    assert found_rows(spark.createDataFrame([], SCHEMA)) == []


def test_another_leaf_gives_another_root(spark):
    docs = spark.createDataFrame([(i, "s", str(i), 1, "x", 2, 3) for i in range(50)], SCHEMA)
    found = manifest(docs, "source", "doc_id", COLUMNS)
    wrong = found.where(folded(F.sha2(F.lit("other"), 256), F.col("path")) == F.col("root"))
    assert found.count() == 50 and wrong.count() == 0
