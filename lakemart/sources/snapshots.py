"""Listing of snapshot folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.paths import normalise_path, path_name

SNAPSHOT_SCHEMA = "path string, complete boolean"


def list_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """(path, complete) of the ``.parquet`` folders; ``complete`` once they hold ``_SUCCESS``.

    The list grows with snapshots: folders and their markers are listed, never their
    part files, and no data is read.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def found(pattern: str) -> list:
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
        return path.getFileSystem(conf).globStatus(path) or []

    done = {f.getPath().getParent().toString() for f in found("*.parquet/_SUCCESS")}
    folders = sorted(f.getPath().toString() for f in found("*.parquet") if f.isDirectory())
    rows = [(p, p in done) for p in folders]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def rows_per_snapshot(df: DataFrame) -> DataFrame:
    """(snapshot, n_files, n_rows) of the files a DataFrame was read from."""
    path = F.col("_metadata.file_path")
    files = df.groupBy(path.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(path_name(normalise_path(F.col("file"))).alias("snapshot")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows")
    )
