"""Append-only load of new snapshots (Bronze)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.contract import check_contract
from lakemart.operators.increment import new_snapshots
from lakemart.plans.counts import RowCount
from lakemart.plans.lineage import delete
from lakemart.plans.runlog import run_logged
from lakemart.plans.store import TableStore
from lakemart.sources.snapshots import list_snapshots


def with_lineage(df: DataFrame, run_id: str, load_ts: dt.datetime) -> DataFrame:
    """Source file, run id and load stamp; all literals, stable over actions."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(run_id).alias("bronze_run_id"),
        F.lit(load_ts).alias("bronze_ingestion_timestamp"),
    )


def _pending(store: TableStore, table: str) -> str:
    return f"{store.root}/{table}/loading.json"


def _note_paths(store: TableStore, table: str, paths: list[str]) -> None:
    noted = store.spark.createDataFrame([(p,) for p in paths], "source_file string").coalesce(1)
    store.append(noted, f"{table}__paths")
    delete(store.spark, _pending(store, table))


def loaded_paths(store: TableStore, table: str) -> DataFrame | None:
    """(source_file) of the snapshots in ``table``, from a manifest kept beside it; None without any.

    A load announces its paths, appends its rows and then notes the paths. If it broke off in
    between, the rows of its run say whether it is to be noted. A table that has no manifest yet
    gets one from its rows, once.
    """
    if not store.exists(table):
        return None
    manifest = f"{table}__paths"
    if not store.exists(manifest):
        store.overwrite(store.read(table).select("source_file").distinct(), manifest)
        delete(store.spark, _pending(store, table))
    begun = store._read_json(_pending(store, table))
    if begun is not None:
        rows = store.read(table).where(F.col("bronze_run_id") == begun["run_id"])
        noted = store.read(manifest).where(F.col("source_file").isin(begun["paths"]))
        if not rows.isEmpty() and noted.isEmpty():
            _note_paths(store, table, begun["paths"])
        else:
            delete(store.spark, _pending(store, table))
    return store.read(manifest)


def load_new_snapshots(
    store: TableStore,
    stage_root: str,
    table: str,
    load_ts: dt.datetime,
    documented: list[str] | None = None,
    allow_break: bool = False,
):
    """Append the snapshots not loaded before; returns (loaded DataFrame or None, run row).

    Nothing new writes nothing and is a success with 0 rows.
    """

    def job(run: dict):
        # A folder without its marker is half written: it is loaded when it is whole.
        listed = list_snapshots(store.spark, f"{stage_root}/{table}").where("complete")
        current = store.read_or_none(table)
        loaded_before = loaded_paths(store, table)
        fresh = listed if loaded_before is None else new_snapshots(listed, loaded_before)
        paths = sorted(r.path for r in fresh.collect())
        run["files_processed"] = len(paths)
        if not paths:
            return None
        read = store.spark.read.option("mergeSchema", "true").parquet(*paths)
        batch = with_lineage(read, run["run_id"], load_ts)
        check_contract(
            table, current.schema if current is not None else None, batch.schema, documented, allow_break
        )
        loaded = RowCount()
        store._write_json(_pending(store, table), {"run_id": run["run_id"], "paths": paths})
        store.append(loaded.on(batch), table, allow_break)
        _note_paths(store, table, paths)
        run["records_read"] = run["records_written"] = loaded.value
        return batch

    return run_logged(store, table, job, load_ts)
