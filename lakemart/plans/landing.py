"""Landing of dated snapshots (Stage)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakemart.functions.dates import partition_columns
from lakemart.functions.paths import path_name, snapshot_name
from lakemart.functions.values import parse_date
from lakemart.operators.increment import pending_snapshots
from lakemart.plans.counts import NullCount, RowCount
from lakemart.plans.lineage import delete
from lakemart.plans.store import gathered
from lakemart.sources.snapshots import list_snapshots

YEAR, MONTH = "partition_year", "partition_month"


def stamp(df: DataFrame, table: str, run_ts: dt.datetime, default_source: str) -> DataFrame:
    """Run stamp and lineage; the stamp is one literal, the same in every action."""
    source = F.lit(default_source)
    if "source" in df.columns:
        source = F.coalesce(F.col("source"), source)
    return df.withColumns(
        {"ingestion_timestamp": F.lit(run_ts), "source": source, "endpoint": F.lit(table)}
    )


def with_partition(df: DataFrame, run_ts: dt.datetime, date_column: str | None) -> DataFrame:
    """Year and month of the business date (NULL: run date), or of the run stamp."""
    if date_column is None:
        return df.withColumns(partition_columns(F.col("ingestion_timestamp")))
    return df.withColumns(partition_columns(_as_date(df, date_column), run_ts.date()))


def _as_date(df: DataFrame, name: str):
    is_text = isinstance(df.schema[name].dataType, StringType)
    return parse_date(F.col(name)) if is_text else F.col(name)


def partition_counts(df: DataFrame, by=(YEAR, MONTH)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def land_snapshot(
    df: DataFrame,
    root: str,
    table: str,
    run_ts: dt.datetime,
    date_column: str | None = None,
    cutoff: dt.date | None = None,
    required=(),
    default_source: str = "unknown",
    run: dict | None = None,
) -> DataFrame | None:
    """Write the snapshot's (year, month) folders that this day has not completed yet.

    The feed is read once: one partitioned job writes a staging folder and counts on
    the way the rows before the cut-off (``run["records_read"]``) and NULLs of the
    mandatory columns. If these pass, the folders that are pending move into place. A
    folder counts as complete once it holds ``_SUCCESS``, written last, so a half-written
    one is replaced on the next run. Returns None when the input is empty.
    """
    spark, run = df.sparkSession, run if run is not None else {}
    name = snapshot_name(F.col(YEAR), F.col(MONTH), run_ts.date(), table)

    def prepared(rows: DataFrame) -> DataFrame:
        if cutoff is not None and date_column is not None:
            rows = rows.filter(F.col(date_column) >= F.lit(cutoff.isoformat()))
        stamped = stamp(rows, table, run_ts, default_source)
        dated = with_partition(stamped, run_ts, date_column)
        return dated.withColumn("snapshot", name).drop(YEAR, MONTH)

    base = f"{root}/{table}"
    # Hidden from readers and listings by its underscore.
    staged = f"{base}/_staging-{uuid.uuid4().hex}"
    total, nulls = RowCount(), NullCount(required)
    try:
        (
            gathered(nulls.on(prepared(total.on(df))), ["snapshot"])
            .write.partitionBy("snapshot")
            .parquet(staged)
        )
        run["records_read"] = total.value
        if nulls.value:
            raise ValueError(f"{table}: NULL in mandatory columns {nulls.value}; nothing was written")
        written = _staged_counts(spark, staged)
        if not written:
            return None
        wanted = spark.createDataFrame([(s,) for s in written], "snapshot string")
        landed = list_snapshots(spark, base).select(
            F.regexp_replace(path_name(F.col("path")), "^snapshot=", "").alias("snapshot"), "complete"
        )
        pending = [r.snapshot for r in pending_snapshots(wanted, landed, ["snapshot"]).collect()]
        for snapshot in pending:
            _move(spark, f"{staged}/snapshot={snapshot}", f"{base}/snapshot={snapshot}")
        mark_complete(spark, [f"{base}/snapshot={s}" for s in pending])
    finally:
        delete(spark, staged)
        _drop_if_empty(spark, base)
    run["files_written"] = len(pending)
    run["files_skipped"] = len(written) - len(pending)
    run["records_written"] = sum(written[s] for s in pending)
    return prepared(df).drop("snapshot")


def _staged_counts(spark: SparkSession, staged: str) -> dict[str, int]:
    """Rows of each staged folder; counts come from the files' footers."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staged}/snapshot=*")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path):
        return {}
    rows = spark.read.schema("snapshot string").parquet(staged).groupBy("snapshot").count()
    return {r["snapshot"]: r["count"] for r in rows.collect()}


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of a half-written one, if there is any."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    delete(spark, target)
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def _drop_if_empty(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and not fs.listStatus(path):
        fs.delete(path, False)


def mark_complete(spark: SparkSession, folders: list[str]) -> None:
    conf = spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        path.getFileSystem(conf).create(path, True).close()
