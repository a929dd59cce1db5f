"""Positions of rows in an order over the whole table, without a window over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.plans.lineage import cut_lineage

#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
_ROW_BITS = 33


def ranked(rows: DataFrame, groups: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` from 0 within the rows' group, and ``size``, the rows of the group.

    ``order`` has to tell all rows apart. Rows are dealt by ranges of (groups, order), so a
    group with most rows becomes many partitions. The sorted partitions are written once;
    a position is that inside the partition and the rows of the group in earlier ones. The
    table of those sums has a row per partition and one more per group. NULL groups come first.
    """
    keys = [*(F.col(name).asc_nulls_first() for name in groups), *order]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = cut_lineage(laid.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", _ROW_BITS)
    runs = laid.groupBy(*groups, part.alias("_part")).agg(
        F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    upto = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.select(
        *(F.col(name).alias(f"_run_{name}") for name in groups),
        F.col("_part"),
        (F.sum("_rows").over(upto) - F.col("_rows") - F.col("_from")).alias("_shift"),
        F.sum("_rows").over(whole).alias("size"),
    )
    same = [part == F.col("_part"), *(F.col(name).eqNullSafe(F.col(f"_run_{name}")) for name in groups)]
    joined = laid.join(runs, reduce(Column.__and__, same))
    return joined.withColumn("rank", F.col("_at") + F.col("_shift")).select(*rows.columns, "rank", "size")
