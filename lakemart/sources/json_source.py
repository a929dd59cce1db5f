"""JSON sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: Malformed input fails the run; a PERMISSIVE read would turn it into rows of NULLs
#: that a later filter drops without a word.
ON_ERROR = "FAILFAST"


def scan_jsonl(
    spark: SparkSession, path, schema: StructType, spread: bool | None = None, mode: str = ON_ERROR
) -> DataFrame:
    """One object per line, gzip or plain; blank lines are skipped, broken ones fail.

    A gzip file cannot be split, so its rows are spread over the cluster before
    any further work; ``spread`` says so for a folder of such files.
    """
    df = spark.read.option("mode", mode).schema(schema).json(path)
    if spread is None:
        spread = any(p.endswith(".gz") for p in ([path] if isinstance(path, str) else path))
    return df.hint("rebalance") if spread else df


def scan_pages(
    spark: SparkSession, path, item_schema: StructType, data: str = "data", mode: str = ON_ERROR
) -> DataFrame:
    """Paged documents ``{data: [...]}`` as rows, in page and item order.

    ``_page`` (the last number in the file's name) and ``_position`` carry the order;
    a distributed table has none. A truncated page fails.
    """
    schema = StructType([StructField(data, ArrayType(item_schema))])
    pages = spark.read.option("multiLine", True).option("mode", mode).schema(schema).json(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"([0-9]+)[^0-9]*$", 1)
    items = pages.select(
        number.try_cast("long").alias("_page"),
        F.posexplode(data).alias("_position", "_item"),
    )
    return items.select("_item.*", "_page", "_position")


def rejected_lines(text: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The rows whose JSON text does not parse under ``schema``; blank ones aren't any.

    To see what a failed scan has stumbled over.
    """
    bad = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = text.withColumn("_json", F.from_json(column, bad, options))
    return parsed.where(
        (F.trim(column) != "") & F.col("_json._corrupt_record").isNotNull()
    ).drop("_json")


def json_column(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The fields of a JSON text column lifted beside the other columns."""
    parsed = df.withColumn("_json", F.from_json(column, schema))
    return parsed.select(*df.columns, "_json.*")
