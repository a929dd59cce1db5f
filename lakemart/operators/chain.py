"""Chains of renamed ids (old id to new id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.skew import spread_join


def latest_edges(events: DataFrame, old: str, new: str, order_by: list[str]) -> DataFrame:
    """One edge (old, new) per old id: the latest by ``order_by``, NULLs losing."""
    # A window limited to the first row keeps one row per id before the shuffle.
    latest = Window.partitionBy(old).orderBy(*(F.col(c).desc_nulls_last() for c in [*order_by, new]))
    ranked = events.filter(F.col(old).isNotNull() & F.col(new).isNotNull()).withColumn(
        "_rank", F.row_number().over(latest)
    )
    return ranked.filter("_rank = 1").select(F.col(old).alias("old"), F.col(new).alias("new"))


def walks(edges: DataFrame, max_hops: int = 10) -> DataFrame:
    """(old, path): the ids met one after the other from each ``old``, ``max_hops`` at most.

    A path goes round in a cycle; ``ended_at`` takes its distinct beginning. Walks double in length
    each round: the path of 2n hops is the path of n hops followed by that of its
    end, so 10 hops need 4 joins, and the whole stays one lazy distributed plan.
    Revisits need no check on the way: each id has one successor, so after the
    first repetition a walk only repeats, and its distinct prefix is the answer.

    Many walks may meet in one id. Edges read from a table (see ``cut_lineage``)
    are shuffled on both sides of every join, so adaptive execution can split it.
    """
    paths, length = edges.select("old", F.array("new").alias("path")), 1
    while length < max_hops:
        step = min(length, max_hops - length)
        tails = paths.select(
            F.col("old").alias("_at"), F.slice("path", 1, step).alias("_tail")
        )
        # A walk shorter than the round's length has ended: its end has no edge,
        # so it finds no tail. Looking up its own end spreads ended walks over all
        # partitions; a NULL key would gather them in one.
        paths = paths.join(tails, F.element_at("path", -1) == F.col("_at"), "left").select(
            "old",
            F.when(F.col("_tail").isNull(), F.col("path"))
            .otherwise(F.concat("path", "_tail"))
            .alias("path"),
        )
        length += step
    return paths


def resolve_chain(edges: DataFrame, max_hops: int = 10) -> DataFrame:
    """(old, canonical, hops): follow the edges for at most ``max_hops``.

    A walk stops before it would revisit any of its ids.
    """
    return ended_at(walks(edges, max_hops))


def ended_at(paths: DataFrame) -> DataFrame:
    """(old, canonical, hops) of walks."""
    walk = F.array_distinct(F.concat(F.array("old"), F.col("path")))
    return paths.select(
        "old", F.element_at(walk, -1).alias("canonical"), (F.size(walk) - 1).alias("hops")
    )


def attach_canonical(
    df: DataFrame, resolved: DataFrame, id_column: str, output: str, hot: list | None = None
) -> DataFrame:
    """Add the final id of ``id_column``; ids without an edge keep themselves.

    ``hot`` lists ids with very many rows when known, else they are looked for.
    """
    known = resolved.select(F.col("old").alias("_old"), F.col("canonical").alias("_canonical"))
    own: Column = F.col(id_column)
    joined = spread_join(df, known, id_column, "_old", "left", hot)
    return joined.withColumn(output, F.coalesce("_canonical", own)).drop("_old", "_canonical")
