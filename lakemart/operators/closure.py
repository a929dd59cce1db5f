"""Incremental closure of renamed ids: only walks that meet a changed id are taken again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_edges(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id) whose edge is new, gone or leads elsewhere. Both have one (old, new) per old id."""
    then = before.select(F.col("old").alias("was"), F.col("new").alias("led_to"))
    both = after.join(then, F.col("old") == F.col("was"), "full_outer").where(~F.col("new").eqNullSafe(F.col("led_to")))
    return both.select(F.coalesce("old", "was").alias("id"))


def walk_index(paths: DataFrame) -> DataFrame:
    """(id, old): the ids that each walk of (old, path) meets, its own one too."""
    met = F.array_distinct(F.concat(F.array("old"), F.col("path")))
    return paths.select(F.explode(met).alias("id"), "old")


def broken_walks(index: DataFrame, changed: DataFrame, edges: DataFrame) -> DataFrame:
    """(old) of the walks that a change reaches, and of ids that had none before."""
    met = index.join(changed, "id", "left_semi").select("old")
    begun = edges.join(changed.select(F.col("id").alias("old")), "old", "left_semi").select("old")
    return met.unionAll(begun).distinct()


def renewed_walks(kept: DataFrame, broken: DataFrame, edges: DataFrame, max_hops: int = 10, cut=None) -> DataFrame:
    """(old, path) of the broken walks by the present edges.

    A walk that comes to an id whose walk is kept takes that one's path over. The others
    double in length each round, as in ``walks``. ``kept`` are the walks no change reaches.
    """
    again = edges.join(broken, "old", "left_semi").select("old", F.array("new").alias("path"))
    length = 1
    while length < max_hops:
        again = cut(again, "walks") if cut else again
        ends = again.select(F.element_at("path", -1).alias("old")).distinct()
        tails = again.unionByName(kept.select("old", "path").join(ends, "old", "left_semi"))
        tails = tails.select(F.col("old").alias("_at"), F.col("path").alias("_tail"))
        whole = F.when(F.col("_tail").isNull(), F.col("path")).otherwise(F.concat("path", "_tail"))
        again = again.join(tails, F.element_at("path", -1) == F.col("_at"), "left").select(
            "old", F.slice(whole, 1, max_hops).alias("path")
        )
        length *= 2
    return again


def update_closure(paths: DataFrame, before: DataFrame, after: DataFrame, max_hops: int = 10, cut=None) -> DataFrame:
    """The walks by the edges ``after``, from those by the edges ``before``; equal to ``walks(after)``."""
    changed = changed_edges(before, after)
    changed = cut(changed, "changed") if cut else changed
    broken = broken_walks(walk_index(paths), changed, after)
    broken = cut(broken, "broken") if cut else broken
    # Walks of ids that have lost their edge are broken too, and not begun again.
    kept = paths.join(broken, "old", "left_anti")
    return kept.unionByName(renewed_walks(kept, broken, after, max_hops, cut))
