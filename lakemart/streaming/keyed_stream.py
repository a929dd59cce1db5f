"""Bronze to Silver as micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.store import TableStore


def _mark(store: TableStore, table: str, stream: str) -> str:
    return f"{store.root}/{table}/stream-{stream}.json"


def save_batch(
    batch: DataFrame, batch_id: int, store: TableStore, table: str, stream: str, keys, **save
) -> bool:
    """Upsert one numbered batch of a stream; a batch that was saved before changes nothing.

    The number is noted after the save. A run that ends in between saves the same rows again, which
    an upsert of unique keys leaves as they are.
    """
    done = store._read_json(_mark(store, table, stream)) if store.exists(table) else None
    if done is not None and batch_id <= done["batch_id"]:
        return False
    save_keyed(batch, store, table, keys, **save)
    store._write_json(_mark(store, table, stream), {"batch_id": batch_id})
    return True


def upsert_stream(
    source: TableStore,
    source_table: str,
    store: TableStore,
    table: str,
    keys,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    stream: str = "bronze",
    max_files_per_batch: int = 1000,
    **save,
) -> None:
    """Bring the rows of an append-only table that ``checkpoint`` has not seen into a keyed one, then stop.

    The stream reads one folder, whatever was appended to it; its checkpoint knows the files.
    ``save`` are options of ``save_keyed``. An overwrite of the source is a new folder and comes in
    as a whole, as its rows may all have changed.
    """
    rows = (
        source.spark.readStream.schema(source.schema(source_table))
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(source.location(source_table))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        save_batch(transform(batch), batch_id, store, table, stream, keys, **save)

    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
