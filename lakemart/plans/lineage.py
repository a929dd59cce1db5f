"""Shared work folder and lineage cuts.

Executors may be lost at any time, so a cut is a table written to the folder the
cluster names in ``spark.checkpoint.dir``, never a block kept on executors.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only for local sessions without any."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="lakemart-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def _application_dir(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/lakemart/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back with the same schema. Stays until ``clear_scratch``."""
    return _written(df, new_path(df.sparkSession, label))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """``cut(df, label)`` whose tables are removed when the job using them is done."""
    paths = []

    def cut(df: DataFrame, label: str) -> DataFrame:
        paths.append(new_path(spark, label))
        return _written(df, paths[-1])

    try:
        yield cut
    finally:
        for path in paths:
            delete(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all cut tables of this application."""
    delete(spark, _application_dir(spark))
