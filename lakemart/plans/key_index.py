"""Which partitions of a table can hold the keys of a batch.

Each partition has a zone, the range of each key column, and a blocked Bloom filter: a key
belongs to one block of 256 bits, by the top of its hash, and sets eight bits there. Blocks are
rows, so probing is an equi-join of the batch's blocks with them. Filters never miss a key; one that
answers for a key that isn't there only has a partition read in vain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.plans.companion import FOLDER, Companion
from lakemart.plans.store import TableStore

#: Keys of a block of 256 bits, on average at most.
KEYS_PER_BLOCK = 16
#: Words of 32 bits in a block; a key sets one bit of each.
_WORDS = 8


def _hash(keys: list[str], seed: int) -> Column:
    # Whether a part is NULL is hashed too: NULL alone would leave the hash as it is.
    return F.xxhash64(F.lit(seed), *(x for k in keys for x in (F.col(k).isNull(), F.col(k))))


def _block(level: Column) -> Column:
    """The block of a key in a filter of 2^level blocks."""
    return F.col("h1").bitwiseAND(F.expr("shiftleft(1L, level)") - 1)


def _bit(word: int) -> Column:
    at = F.shiftrightunsigned("h2", 5 * word).bitwiseAND(F.lit(31)).cast("int")
    return F.call_function("shiftleft", F.lit(1), at)


def zones(store: TableStore, table: str, keys: list[str]) -> Companion:
    def ranges(rows: DataFrame) -> DataFrame:
        bounds = [
            side(F.col(k)).alias(f"{name}_{i}") for i, k in enumerate(keys) for name, side in (("low", F.min), ("high", F.max))
        ]
        nulls = [F.count_if(F.col(k).isNull()).alias(f"nulls_{i}") for i, k in enumerate(keys)]
        return rows.groupBy(FOLDER).agg(F.count(F.lit(1)).alias("n"), *bounds, *nulls)

    return Companion(store, table, "zones_" + "_".join(keys), ranges)


def blooms(store: TableStore, table: str, keys: list[str]) -> Companion:
    def filters(rows: DataFrame) -> DataFrame:
        hashed = rows.select(FOLDER, _hash(keys, 1).alias("h1"), _hash(keys, 2).alias("h2"))
        sizes = rows.groupBy(FOLDER).agg(
            F.greatest(F.lit(0), F.ceil(F.log2(F.count(F.lit(1)) / KEYS_PER_BLOCK))).cast("int").alias("level")
        )
        placed = hashed.join(F.broadcast(sizes), FOLDER).withColumn("block", _block(F.col("level")))
        return placed.groupBy(FOLDER, "level", "block").agg(*(F.bit_or(_bit(i)).alias(f"w{i}") for i in range(_WORDS)))

    return Companion(store, table, "blooms_" + "_".join(keys), filters, str(KEYS_PER_BLOCK))


def _overlaps(batch: DataFrame, keys: list[str]) -> Column:
    """Zones that the batch's own range meets in every key column."""
    own = batch.agg(
        *(side(F.col(k)).alias(f"{name}_{i}") for i, k in enumerate(keys) for name, side in (("low", F.min), ("high", F.max))),
        *(F.count_if(F.col(k).isNull()).alias(f"nulls_{i}") for i, k in enumerate(keys)),
    ).first()
    fits = []
    for i, key in enumerate(keys):
        kind = batch.schema[key].dataType
        fit = F.lit(False)
        if own[f"low_{i}"] is not None:
            low, high = (F.lit(own[f"{side}_{i}"]).cast(kind) for side in ("low", "high"))
            fit = F.coalesce((F.col(f"high_{i}") >= low) & (F.col(f"low_{i}") <= high), F.lit(False))
        fits.append(fit | (F.col(f"nulls_{i}") > 0) if own[f"nulls_{i}"] else fit)
    return reduce(Column.__and__, fits)


def folders_with(store: TableStore, table: str, batch: DataFrame, keys: list[str]) -> list[str]:
    """Partition folders that may hold a key of the batch; the others hold none."""
    near = zones(store, table, keys).refresh().where(_overlaps(batch, keys))
    folders = [row[FOLDER] for row in near.select(FOLDER).collect()]
    if not folders:
        return []
    filters = blooms(store, table, keys).refresh().where(F.col(FOLDER).isin(folders))
    levels = [row["level"] for row in filters.select("level").distinct().collect()]
    asked = batch.select(_hash(keys, 1).alias("h1"), _hash(keys, 2).alias("h2"))
    asked = asked.withColumn("level", F.explode(F.array(*map(F.lit, levels)))).withColumn("block", _block(F.col("level")))
    asked = asked.select(F.col("level").alias("asked_level"), F.col("block").alias("asked_block"), *(_bit(i).alias(f"b{i}") for i in range(_WORDS)))
    held = [F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0 for i in range(_WORDS)]
    same = (F.col("level") == F.col("asked_level")) & (F.col("block") == F.col("asked_block"))
    hit = asked.join(filters, reduce(Column.__and__, held, same))
    return sorted(row[FOLDER] for row in hit.select(FOLDER).distinct().collect())
