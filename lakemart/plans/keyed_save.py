"""Saving keyed tables (Silver and Gold)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.contract import check_contract, compare_fields, field_types, retype
from lakemart.operators.keyed import (
    check_batch_keys,
    check_keys,
    dedup_any,
    dedup_latest,
    keyed_side,
    same_key,
    upsert,
)
from lakemart.plans.key_index import folders_with, zones
from lakemart.plans.lineage import scratch
from lakemart.plans.store import TableStore, with_folder


def save_keyed(
    df: DataFrame,
    store: TableStore,
    table: str,
    keys=(),
    order_by: str | None = None,
    partition_by=(),
    documented: list[str] | None = None,
    allow_break: bool = False,
    on_duplicate: str = "latest",
    mode: str = "upsert",
    key_decides_partition: bool = False,
) -> None:
    """Check the batch, then write, upsert or overwrite ``table``.

    ``on_duplicate``: "latest" keeps one row per key (newest by ``order_by``, else
    a fixed one), "abort" raises before anything is written. Without keys, or with
    ``mode`` "overwrite", the table is replaced. ``key_decides_partition`` says the
    partition follows from the key, so an upsert needs to look only at the batch's
    own partitions; otherwise a row may move and the old one is searched for.
    """
    keys, partition_by = list(keys), list(partition_by)
    if store.exists(table):
        store.recover(table)
    current = store.read_or_none(table)
    check_contract(table, current.schema if current is not None else None, df.schema, documented, allow_break)
    if keys and on_duplicate == "latest":
        has_order = order_by is not None and order_by in df.columns
        df = dedup_latest(df, keys, order_by) if has_order else dedup_any(df, keys)

    def gate(written: DataFrame) -> None:
        if keys:
            check_keys(written, keys, table)

    if current is None or not keys or mode == "overwrite":
        store.overwrite(df, table, partition_by, check=gate)
        return

    with scratch(store.spark) as cut:
        batch = cut(df, f"batch-{table}")
        if batch.isEmpty():
            return
        if on_duplicate == "abort":
            check_batch_keys(batch, keys, table)
        # The stored rows passed this check when they came in, and an upsert of
        # unique keys keeps them unique: the history need not be scanned again.
        check_keys(batch, keys, table)
        diff = compare_fields(field_types(current.schema), field_types(df.schema))
        if not partition_by or any(kind == "retyped" for _, kind, _, _ in diff):
            # The stored rows take the batch's types where an allowed break changed them.
            merged = upsert(retype(current, batch.schema, table), batch, keys)
            store.overwrite(merged, table, partition_by, check=gate)
        else:
            _upsert_partitions(
                store, table, current, batch, keys, partition_by, key_decides_partition
            )


def _upsert_partitions(store, table, current, batch, keys, partition_by, key_decides_partition):
    """Rewrite only the partitions holding replaced rows or receiving new ones."""
    own = batch.select(*partition_by).distinct()
    if not key_decides_partition:
        # A row may move: its old place is looked for where its key can be.
        possible = folders_with(store, table, batch, keys)
        searched = zones(store, table, keys).rows_of(possible)
        replaced = searched.join(keyed_side(batch, keys), same_key(keys), "left_semi")
        own = own.union(replaced.select(*partition_by)).distinct()
    affected = current.filter(in_partitions([tuple(r) for r in own.collect()], partition_by))
    touched = with_folder(affected).select(*partition_by, "_folder").distinct().collect()
    store.replace_partitions(upsert(affected, batch, keys), table, partition_by, touched)


def in_partitions(values: list[tuple], names: list[str]) -> Column:
    """Literal predicate on the partition columns, so the scan is pruned; never NULL."""
    if not values:
        return F.lit(False)
    if len(names) == 1:
        firsts = [v[0] for v in values if v[0] is not None]
        hit = F.col(names[0]).isNotNull() & F.col(names[0]).isin(*firsts) if firsts else F.lit(False)
        return hit | F.col(names[0]).isNull() if len(firsts) < len(values) else hit
    groups: dict = {}
    for first, *rest in values:
        groups.setdefault(first, []).append(tuple(rest))
    parts = [F.col(names[0]).eqNullSafe(v) & in_partitions(rest, names[1:]) for v, rest in groups.items()]
    return reduce(lambda a, b: a | b, parts)
