import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators.chain import attach_canonical, latest_edges, resolve_chain


def walk(edges, start, limit=10):
    """Brute force: step until the end, a known id or the limit."""
    seen = [start]
    while len(seen) <= limit and edges.get(seen[-1], start) not in seen:
        seen.append(edges[seen[-1]])
    return seen[-1]


def resolved(spark, edges, **options):
    df = spark.createDataFrame(list(edges.items()), "old string, new string")
    return {r.old: r.canonical for r in resolve_chain(df, **options).collect()}


@pytest.mark.parametrize(
    "edges, want",
    [
        ({}, {}),
        # A fork joins a path of three that ends outside the map.
        ({"kid": "mid", "sib": "mid", "mid": "top", "top": "end"}, dict.fromkeys(["kid", "sib", "mid", "top"], "end")),
        # A tail of two leads into a ring of three; walks stop before they repeat.
        (
            {"t2": "t1", "t1": "r1", "r1": "r2", "r2": "r3", "r3": "r1"},
            {"t2": "r3", "t1": "r3", "r1": "r3", "r2": "r1", "r3": "r2"},
        ),
        ({"self": "self", "to": "self"}, {"self": "self", "to": "self"}),
    ],
)
def test_known_chains(spark, edges, want):
    assert resolved(spark, edges) == want


def test_stops_after_ten_hops(spark):
    got = resolved(spark, {f"n{i}": f"n{i + 1}" for i in range(11)})
    assert got["n0"] == "n10" and got["n1"] == "n11" and got["n10"] == "n11"


@pytest.mark.parametrize("limit", [1, 3, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_maps_match_brute_force(spark, seed, limit):
    pick = random.Random(seed)
    edges = {f"n{i}": f"n{pick.randrange(60)}" for i in pick.sample(range(60), 45)}
    assert resolved(spark, edges, max_hops=limit) == {a: walk(edges, a, limit) for a in edges}


def test_many_ids_into_one(spark):
    edges = {f"n{i}": "hub" for i in range(500)} | {"hub": "last"}
    assert set(resolved(spark, edges).values()) == {"last"}


def test_latest_edge_and_nulls(spark):
    day = dt.date
    events = spark.createDataFrame(
        [
            ("k7", "p", day(2019, 11, 30), "e4"),
            ("k7", "q", day(2019, 11, 28), "e9"),
            ("k7", "r", day(2019, 11, 29), "e5"),
            ("k7", "s", None, "e8"),
            ("k8", None, day(2022, 2, 2), "e1"),
            ("k9", "v", day(2022, 2, 2), "e3"),
            ("k9", "u", day(2022, 2, 2), "e2"),
        ],
        "old_id string, new_id string, d date, id string",
    )
    edges = latest_edges(events, "old_id", "new_id", ["d", "id"])
    assert {r.old: r.new for r in edges.collect()} == {"k7": "p", "k9": "v"}
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_attach_keeps_own_id_without_edge(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "id string")
    edges = spark.createDataFrame([("A", "B"), ("B", "C")], "old string, new string")
    got = attach_canonical(df, resolve_chain(edges), "id", "final")
    assert {r.id: r.final for r in got.collect()} == {"A": "C", "Z": "Z", None: None}
    empty = attach_canonical(df, resolve_chain(edges.filter(F.lit(False))), "id", "final")
    assert {r.id: r.final for r in empty.collect()} == {"A": "A", "Z": "Z", None: None}
