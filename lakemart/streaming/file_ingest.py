"""File-idempotent ingestion as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.contract import check_contract
from lakemart.plans.counts import RowCount
from lakemart.plans.runlog import run_logged
from lakemart.plans.store import TableStore
from lakemart.sources.snapshots import list_snapshots

BATCH = "bronze_batch_id"


def ingest_new_files(
    store: TableStore,
    source: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    load_ts: dt.datetime,
    documented: list[str] | None = None,
    max_files_per_batch: int = 1000,
) -> None:
    """Process every file of whole snapshots not seen by ``checkpoint``, then stop.

    ``source`` holds snapshot folders; those without their commit marker wait, as their
    files are replaced when they are landed again. A source that is itself one written
    folder is read as it is.

    Each micro-batch passes the schema contract, is written under its batch id (a
    repeated batch replaces itself) and leaves a ledger row.
    """
    snapshots = list_snapshots(store.spark, source)
    folders = [row["path"] for row in snapshots.where("complete").collect()]
    if snapshots.isEmpty():
        path = source
    elif folders:
        # Only whole folders are listed to the stream; its checkpoint knows files by path.
        names = sorted(folder.rsplit("/", 1)[1] for folder in folders)
        path = f"{folders[0].rsplit('/', 1)[0]}/{{{','.join(names)}}}"
    else:
        return
    files = (
        store.spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
        .withColumn("bronze_ingestion_timestamp", F.lit(load_ts))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        def job(run: dict) -> DataFrame:
            current = store.read_or_none(table)
            known = current.drop(BATCH).schema if current is not None else None
            check_contract(table, known, batch.schema, documented)
            rows = RowCount()
            store.put_batch(rows.on(batch), table, BATCH, batch_id)
            run["records_read"] = run["records_written"] = rows.value
            return batch

        run_logged(store, table, job, load_ts, params={"batch_id": batch_id})

    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
