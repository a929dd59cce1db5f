"""Keyed tables: dedupe, null-safe upsert, key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


class KeyViolation(RuntimeError):
    """A key column holds NULLs, or a key occurs more than once."""


def _orderable(df: DataFrame, name: str) -> Column:
    is_map = isinstance(df.schema[name].dataType, MapType)
    return F.to_json(F.col(name)) if is_map else F.col(name)


def tie_break_columns(df: DataFrame, keys: list[str], order_by: str | None = None) -> list[str]:
    """Columns left to settle a tie: all but the key and the recency column."""
    return [c for c in df.columns if c not in keys and c != order_by]


def dedup_latest(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """Keep the newest row per key; NULL recency loses.

    Ties are settled by the other columns, highest first, so the result does not
    depend on partitioning. Spark limits each key to one row before the shuffle
    (window group limit), so a key holding most rows costs one row per task.
    """
    ties = [_orderable(df, c).desc_nulls_last() for c in tie_break_columns(df, keys, order_by)]
    window = Window.partitionBy(*keys).orderBy(F.col(order_by).desc_nulls_last(), *ties)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key when no column tells which is newer: the lowest one."""
    rest = [_orderable(df, c).asc_nulls_last() for c in tie_break_columns(df, keys)]
    window = Window.partitionBy(*keys).orderBy(*(rest or [F.lit(1)]))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keyed_side(df: DataFrame, keys: list[str], take=()) -> DataFrame:
    """The key columns under private names, ready to join another table null-safely."""
    return df.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *take)


def same_key(keys: list[str]) -> Column:
    """Null-safe equality with a ``keyed_side``: a NULL key matches a NULL key."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows replace target rows of the same key, the rest of the target stays.

    Rows get NULL in columns only the other side has, but a replaced row keeps
    the target's value in columns the batch does not carry.
    """
    kept = target.join(keyed_side(batch, keys), same_key(keys), "left_anti")
    absent = [c for c in target.columns if c not in batch.columns]
    if absent:
        old = keyed_side(target, keys, absent)
        batch = batch.join(old, same_key(keys), "left").drop(*[f"_key_{k}" for k in keys])
    return kept.unionByName(batch, allowMissingColumns=True)


def key_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: NULLs per key column and surplus rows of repeated keys, in one scan.

    The key is compared as a struct: joining the parts to one text would take
    ('a', 'bc') and ('ab', 'c') for the same key.
    """
    nulls = [F.count_if(F.col(k).isNull()).alias(k) for k in keys]
    distinct = F.count_distinct(F.struct(*keys))
    return df.agg(*nulls, (F.count(F.lit(1)) - distinct).alias("duplicates"))


def check_keys(df: DataFrame, keys: list[str], table: str) -> None:
    found = key_report(df, keys).first().asDict()
    duplicates = found.pop("duplicates")
    for name, n in found.items():
        if n:
            raise KeyViolation(f"key column {name} of {table} is NULL in {n} row(s)")
    if duplicates:
        raise KeyViolation(f"key ({', '.join(keys)}) of {table} has {duplicates} duplicate row(s)")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_batch_keys(df: DataFrame, keys: list[str], table: str) -> None:
    n = duplicated_keys(df, keys).count()
    if n:
        raise KeyViolation(f"batch of {table} repeats {n} key(s) ({', '.join(keys)})")
