"""Joins whose many-side may hold most of its rows under one key.

Adaptive execution splits a hot key by itself when both join inputs are shuffled
for that join, so plain joins suffice where both sides are scans or written
tables. ``spread_join`` is for the others: a side that is already partitioned by
the key, because it was grouped by it, takes part without a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of the rows on, so there are at most 1 / share of them.
HOT_SHARE = 1 / 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys holding more than ``share`` of the rows; None is one if NULLs do.

    A scan of the key column keeps at most ``1 / share`` counters per task and finds all
    of them with some others; a second one counts what it has found.
    """
    found = df.select(key).freqItems([key], share).first()[0]
    known = [value for value in found if value is not None]
    candidate = F.col(key).isin(*known) if known else F.lit(False)
    kind = F.when(F.col(key).isNull(), 0).when(candidate, 1).otherwise(2).alias("_kind")
    value = F.when(candidate, F.col(key)).alias("_value")
    counts = df.groupBy(kind, value).count().collect()
    total = sum(row["count"] for row in counts)
    return [row["_value"] for row in counts if row["_kind"] < 2 and row["count"] > share * total]


def spread_join(
    many: DataFrame, one: DataFrame, many_key: str, one_key: str, how: str = "inner", hot: list | None = None
) -> DataFrame:
    """Equi join of ``many`` with ``one``, which has at most one row per key.

    Rows of hot keys are salted over all shuffle partitions, by the hash of their other
    columns, and the few matching rows of ``one`` repeated for every salt. Without hot
    keys it is a plain join. The result does not depend on which keys are found hot. ``how`` is
    inner, left, left_semi or left_anti; ``one_key`` stays in the result of the
    first two.
    """
    if hot is None:
        hot = hot_keys(many, many_key)
    if not hot:
        return many.join(one, F.col(many_key) == F.col(one_key), how)
    salts = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashable = [f.name for f in many.schema.fields if "map<" not in f.dataType.simpleString()]
    rest = [c for c in hashable if c != many_key] or [many_key]
    values = [value for value in hot if value is not None]
    spread = F.col(many_key).isin(*values) if values else F.lit(False)
    if None in hot:
        spread |= F.col(many_key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")).otherwise(0)
    repeated = F.when(
        F.col(one_key).isin(*values) if values else F.lit(False), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    left = many.withColumn("_salt", salt)
    right = one.withColumn("_salt_of_one", F.explode(repeated))
    match = (F.col(many_key) == F.col(one_key)) & (F.col("_salt") == F.col("_salt_of_one"))
    return left.join(right, match, how).drop("_salt", "_salt_of_one")
