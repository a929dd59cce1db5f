"""How many rows each id has in a table, kept up to date from the partitions that change.

Beside the counts of each partition there is one table of totals, (id, n). A run adds the
counts of changed partitions and takes away what they had before, so neither the table nor the counts of
other partitions are read. The totals name the state of the counts they were made from; if
a run broke off in between they are summed anew from the counts of all partitions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.plans.companion import FOLDER, Companion
from lakemart.plans.lineage import scratch
from lakemart.plans.store import TableStore


def _counts(store: TableStore, table: str, key: str) -> Companion:
    def counted(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).groupBy(FOLDER, F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))

    return Companion(store, table, f"ids_{key}", counted)


def _state(parts: dict[str, str]) -> str:
    return hashlib.sha256("\n".join(sorted(f"{f}={p}" for f, p in parts.items())).encode()).hexdigest()


def reference_counts(store: TableStore, table: str, key: str) -> DataFrame:
    """(id, n) of the ids that ``table`` has now; NULL is none of them."""
    counts, totals = _counts(store, table, key), f"{table}__refs_{key}"
    mark = f"{store.root}/{totals}-state.json"
    before, now = counts.known(), counts.parts()
    made_from = (store._read_json(mark) or {}).get("state")
    if store.exists(totals) and made_from == _state(now) == _state(before):
        return store.read(totals)
    with scratch(store.spark) as cut:
        if store.exists(totals) and made_from == _state(before):
            left = [f for f in before if now.get(f) != before[f]]
            fresh = [f for f in now if now[f] != before.get(f)]
            # Taken before the refresh, which removes them.
            gone = cut(counts.read().where(F.col(FOLDER).isin(left)).select("id", (-F.col("n")).alias("n")), "gone")
            came = counts.refresh().where(F.col(FOLDER).isin(fresh)).select("id", "n")
            changes = store.read(totals).unionAll(gone).unionAll(came)
        else:
            changes = counts.refresh().select("id", "n")
        summed = changes.groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")
        store.overwrite(summed, totals)
    store._write_json(mark, {"state": _state(now)})
    return store.read(totals)


def unmatched_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row (left_only, right_only): ids of one table of reference counts that the other lacks."""
    other = right.select(F.col("id").alias("other"))
    both = left.select("id").join(other, F.col("id") == F.col("other"), "full_outer")
    return both.agg(
        F.count_if(F.col("other").isNull()).alias("left_only"), F.count_if(F.col("id").isNull()).alias("right_only")
    )
