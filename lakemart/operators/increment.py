"""Reading only what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.paths import normalise_path


def read_increment(
    source: DataFrame, target: DataFrame | None, source_ts: str, target_ts: str | None = None
) -> DataFrame:
    """Source rows newer than the target's newest; all of them without a target.

    The bound is fetched first, so it reaches the source scan as a pushed filter.
    """
    if target is None:
        return source
    return newer_than(source, source_ts, target.agg(F.max(target_ts or source_ts)).first()[0])


def newer_than(source: DataFrame, source_ts: str, bound) -> DataFrame:
    """Source rows after a mark; all of them without one."""
    if bound is None:
        return source
    kind = source.schema[source_ts].dataType
    return source.filter(F.col(source_ts) > F.lit(bound).cast(kind))


def new_snapshots(listed: DataFrame, loaded: DataFrame, source_file: str = "source_file") -> DataFrame:
    """Listed paths not yet among the loaded rows' source files."""
    files = loaded.select(source_file).distinct()
    seen = files.select(normalise_path(F.col(source_file)).alias("_seen"))
    path = normalise_path(F.col("path"))
    return listed.join(seen, path == F.col("_seen"), "left_anti")


def pending_snapshots(wanted: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions to write: wanted ones not already completely landed."""
    complete = landed.filter("complete").select(*keys)
    return wanted.join(complete, keys, "left_anti")


def window_members(df: DataFrame, code: str, lookup: DataFrame, lookup_code: str) -> DataFrame:
    """Rows whose code is among the lookup's, letter case aside.

    No forced broadcast: Spark broadcasts the lookup when its size allows it.
    """
    codes = lookup.select(F.lower(F.col(lookup_code)).alias("_code")).filter("_code IS NOT NULL")
    return df.join(codes, F.lower(F.col(code)) == F.col("_code"), "left_semi")
