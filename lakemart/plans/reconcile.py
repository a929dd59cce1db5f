"""Late and withdrawn rows: partitions whose source is no longer what they were made from.

A print of a partition is the number of its rows and sums of their hashes, so it doesn't
depend on the order of rows or files, and those of parts add up. A derived table keeps the prints
that its source had when its partitions were made. A full outer join with the present prints
names the partitions to make anew, whatever the time of the rows that came in or went.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.plans.companion import FOLDER, Companion
from lakemart.plans.store import TableStore

PRINT = ["n_rows", "sum_a", "sum_b"]


def row_prints(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, n_rows, sum_a, sum_b) of the rows of each partition."""

    def total(seed: int) -> Column:
        # NULLs leave a hash as it is, so whether a column is NULL is hashed too.
        parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
        return F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)"))

    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), total(1).alias("sum_a"), total(2).alias("sum_b"))


def differing_partitions(now: DataFrame, then: DataFrame, by: list[str]) -> DataFrame:
    """The partitions that two tables of prints don't agree on."""
    a = now.select(*(F.col(c).alias(f"a_{c}") for c in [*by, *PRINT]))
    b = then.select(*(F.col(c).alias(f"b_{c}") for c in [*by, *PRINT]))
    same_key = reduce(Column.__and__, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in by))
    same = reduce(Column.__and__, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in PRINT))
    # A partition that only one side has differs: its prints are NULL on the other.
    found = a.join(b, same_key, "full_outer").where(~same)
    mine = F.col("a_n_rows").isNotNull()
    return found.select(*(F.when(mine, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c) for c in by))


def stored_prints(store: TableStore, table: str, by: list[str], columns: list[str]) -> DataFrame:
    """Prints of a stored table; only folders that changed since the last call are read."""
    prints = Companion(
        store, table, "prints", lambda rows: row_prints(rows, [FOLDER, *by], columns), ",".join([*by, *columns])
    )
    return prints.refresh().groupBy(*by).agg(*(F.sum(c).cast("decimal(38,0)" if c != "n_rows" else "long").alias(c) for c in PRINT))
