"""Checks, marks and hot keys of a table from statistics kept per partition."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.quality import Check, judged
from lakemart.operators.skew import HOT_SHARE
from lakemart.plans.companion import FOLDER, Companion
from lakemart.plans.store import TableStore


def _named(*expressions: Column) -> str:
    """A name for what some expressions compute."""
    return hashlib.sha256("\n".join(str(e) for e in expressions).encode()).hexdigest()[:16]


def check_counters(store: TableStore, table: str, checks: list[Check]) -> Companion:
    """The counts of ``checks`` for each partition. They must add up over rows."""
    counts = [F.coalesce(c.count.cast("bigint"), F.lit(0)).alias(c.name) for c in checks]
    return Companion(
        store, table, "checks", lambda rows: rows.groupBy(FOLDER).agg(*counts), _named(*counts)
    )


def check_table(store: TableStore, table: str, checks: list[Check]) -> DataFrame:
    """The report of ``run_checks`` on a stored table; only partitions that changed since the
    last report are read."""
    counters = check_counters(store, table, checks).refresh()
    return judged(counters.agg(*(F.coalesce(F.sum(c.name), F.lit(0)).alias(c.name) for c in checks)), checks)


def newest(store: TableStore, table: str, column: str):
    """The greatest value of a column, None for an empty table.

    The mark belongs to the files it was taken from, so neither a crash after a write nor a
    partition that was replaced or removed leaves a mark that the rows don't have.
    """
    marks = Companion(
        store, table, f"newest_{column}", lambda rows: rows.groupBy(FOLDER).agg(F.max(column).alias("mark"))
    )
    return marks.refresh().agg(F.max("mark")).first()[0]


#: Keys that the sketch of a partition tells apart, and that it names.
_TRACKED = 1024
_NAMED = int(1 / HOT_SHARE)


def heavy_keys(store: TableStore, table: str, key: str, share: float = HOT_SHARE) -> list:
    """The keys that hold more than about ``share`` of a stored table's rows; None if NULLs do.

    Sketches of the most frequent keys are kept per partition and combined, so the table itself
    is not read beyond partitions that changed. What is hot only decides how a join is spread.
    """

    def sketched(rows: DataFrame) -> DataFrame:
        return rows.groupBy(FOLDER).agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {_TRACKED})").alias("sketch"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(key).isNull()).alias("nulls"),
        )

    sketches = Companion(store, table, f"heavy_{key}", sketched, str(_TRACKED)).refresh()
    # Grouped, as an empty table has no sketch to combine.
    found = sketches.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {_TRACKED}), {_NAMED})").alias("top"),
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
    ).first()
    if found is None:
        return []
    hot = [item["item"] for item in found["top"] or [] if item["item"] is not None and item["count"] > share * found["n"]]
    return [*hot, None] if found["nulls"] > share * found["n"] else hot
