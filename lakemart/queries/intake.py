"""Sources, landing and incremental load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from lakemart.functions.dates import in_release_window, partition_columns
from lakemart.functions.paths import normalise_path, path_name, snapshot_name
from lakemart.functions.values import face_value, json_text_list
from lakemart.operators.increment import (
    new_snapshots,
    pending_snapshots,
    read_increment,
    window_members,
)
from lakemart.operators.quality import null_counts
from lakemart.plans.bronze import with_lineage
from lakemart.plans.landing import land_snapshot, partition_counts, stamp, with_partition
from lakemart.plans.lineage import new_path
from lakemart.plans.store import TableStore
from lakemart.queries.registry import query
from lakemart.sources.json_source import json_column
from lakemart.sources.snapshots import rows_per_snapshot
from lakemart.streaming.file_ingest import ingest_new_files

RUN_TS = dt.datetime(2026, 9, 5, 10, 30)
AS_OF = dt.date(2003, 6, 15)


@query(
    "props_json_flatten",
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def props_json_flatten(t):
    schema = StructType([StructField("k", IntegerType())])
    events = t.events.select("event_id", "event_type", "props")
    return json_column(events, "props", schema).drop("props")


@query(
    "struct_flatten",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS metadata_id,
              CASE WHEN event_type <> 'error' THEN event_type END AS metadata_name FROM events""",
)
def struct_flatten(t):
    metadata = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"))
    nested = t.events.select(
        "event_id", F.when(F.col("event_type") != "error", metadata).alias("metadata")
    )
    return nested.select(
        "event_id",
        F.col("metadata.id").alias("metadata_id"),
        F.col("metadata.name").alias("metadata_name"),
    )


@query(
    "face_fallback",
    """SELECT p_partkey,
              CASE WHEN p_size >= 20 THEN p_brand WHEN p_size <> 5 THEN p_type END AS mana_cost,
              CASE WHEN p_size < 10 THEN '[]' WHEN p_size >= 20 THEN '["' || p_name || '", "' || p_brand || '"]'
                   ELSE '["' || p_type || '"]' END AS colors
       FROM part""",
)
def face_fallback(t):
    """Root keys are absent, empty or present; the first face stands in for absent ones."""
    size = F.col("p_size")
    face = F.struct(F.col("p_type").alias("mana_cost"), F.array("p_type").alias("colors"))
    record = F.to_json(
        F.struct(
            F.when(size >= 20, F.col("p_brand")).alias("mana_cost"),
            F.when(size >= 20, F.array("p_name", "p_brand"))
            .when(size < 10, F.array().cast("array<string>"))
            .alias("colors"),
            F.when(size != 5, F.array(face)).otherwise(F.array().cast(ArrayType(StructType([
                StructField("mana_cost", StringType()),
                StructField("colors", ArrayType(StringType())),
            ])))).alias("card_faces"),
        )
    )
    fields = [StructField("mana_cost", StringType()), StructField("colors", ArrayType(StringType()))]
    schema = StructType(fields + [StructField("card_faces", ArrayType(StructType(fields)))])
    raw = json_column(t.part.select("p_partkey", record.alias("raw")), "raw", schema)
    return raw.select(
        "p_partkey",
        face_value("mana_cost").alias("mana_cost"),
        json_text_list(face_value("colors")).alias("colors"),
    )


@query(
    "release_window",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-01-01'",
)
def release_window(t):
    return t.orders.filter(in_release_window(F.col("o_orderdate"), AS_OF)).select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "window_semi_join",
    """SELECT c_custkey, c_name FROM customer WHERE lower(c_name) IN (
           SELECT lower('CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')) FROM orders
           WHERE o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def window_semi_join(t):
    key = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    released = t.orders.filter(in_release_window(F.col("o_orderdate"), dt.date(2006, 3, 1))).select(
        F.concat(F.lit("CUSTOMER#"), key).alias("code")
    )
    return window_members(t.customer, "c_name", released, "code").select("c_custkey", "c_name")


@query(
    "snapshot_stamp",
    """SELECT doc_id, lang, TIMESTAMP '2026-09-05 10:30:00' AS ingestion_timestamp,
              coalesce(nullif(source, 'src1'), 'default') AS source, 'documents' AS endpoint FROM documents""",
)
def snapshot_stamp(t):
    docs = t.documents.select(
        "doc_id", "lang", F.nullif(F.col("source"), F.lit("src1")).alias("source")
    )
    return stamp(docs, "documents", RUN_TS, "default").withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")
    )


@query(
    "partition_derive",
    """SELECT o_orderkey, CAST(coalesce(year(d), 2026) AS INTEGER) AS partition_year,
              CAST(coalesce(month(d), 9) AS INTEGER) AS partition_month
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d
             FROM orders)""",
)
def partition_derive(t):
    text = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    dated = t.orders.select("o_orderkey", text.alias("released"))
    return with_partition(dated, RUN_TS, "released").drop("released")


@query(
    "partition_counts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS partition_year, CAST(month(o_orderdate) AS INTEGER) AS partition_month,
              count(*) AS n_rows FROM orders GROUP BY ALL""",
)
def partition_counts_query(t):
    return partition_counts(t.orders.select(F.col("o_orderdate")).withColumns(
        partition_columns(F.col("o_orderdate"))
    ))


@query(
    "mandatory_nulls",
    """WITH j AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment, o_orderkey
                  FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey)
       SELECT 'c_custkey' AS column_name, count(*) FILTER (c_custkey IS NULL) AS n_null FROM j
       UNION ALL SELECT 'segment', count(*) FILTER (segment IS NULL) FROM j
       UNION ALL SELECT 'o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM j""",
)
def mandatory_nulls(t):
    finished = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
    joined = t.customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"), "o_orderkey"
    )
    return null_counts(joined, ["c_custkey", "segment", "o_orderkey"])


def _order_snapshots(t):
    months = partition_columns(F.col("o_orderdate"), names=("y", "m"))
    return t.orders.select(
        F.col("o_orderdate"),
        snapshot_name(months["y"], months["m"], RUN_TS.date(), "orders").alias("snapshot"),
    )


_SNAPSHOT = "strftime(o_orderdate, '%Y_%m') || '_20260905_orders.parquet'"


@query(
    "landing_pending",
    f"""SELECT DISTINCT {_SNAPSHOT} AS snapshot FROM orders
        EXCEPT SELECT {_SNAPSHOT} FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '1999-01-01'""",
)
def landing_pending(t):
    """Months already landed before 1999 are complete, the one after is half-written."""
    snapshots = _order_snapshots(t)
    landed = snapshots.groupBy("snapshot").agg(
        (F.max("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).alias("complete")
    )
    return pending_snapshots(snapshots.select("snapshot").distinct(), landed, ["snapshot"])


@query(
    "path_normalise",
    """SELECT page_id, CASE WHEN strpos(p, '.parquet/') > 0
              THEN substr(p, 1, strpos(p, '.parquet/') - 1) || '.parquet' ELSE p END AS path
       FROM (SELECT page_id, regexp_replace(CASE WHEN page_id > 50 THEN url || '.parquet/part-' || page_id ||
                    '.parquet/x' ELSE url END, '^.*?://', '') AS p FROM pages)""",
)
def path_normalise(t):
    part = F.concat("url", F.lit(".parquet/part-"), F.col("page_id"), F.lit(".parquet/x"))
    path = F.when(F.col("page_id") > 50, part).otherwise(F.col("url"))
    return t.pages.select("page_id", normalise_path(path).alias("path"))


@query(
    "snapshot_listing",
    " UNION ALL ".join(
        f"SELECT '{n}.parquet' AS snapshot, count(*) AS n_rows FROM {n}"
        for n in ("orders", "lineitem", "events", "documents", "customer")
    ),
)
def snapshot_listing(t):
    """Rows found per snapshot folder, from the files' metadata column."""
    tables = [t.orders, t.lineitem, t.events, t.documents, t.customer]
    listed = rows_per_snapshot(tables[0])
    for table in tables[1:]:
        listed = listed.unionByName(rows_per_snapshot(table))
    return listed.select("snapshot", "n_rows")


@query(
    "new_files_anti",
    f"""SELECT DISTINCT 's3://lake/stage/' || {_SNAPSHOT} AS path FROM orders
        WHERE {_SNAPSHOT} NOT IN (SELECT {_SNAPSHOT} FROM orders WHERE o_orderdate < TIMESTAMP '2000-02-10')""",
)
def new_files_anti(t):
    snapshots = _order_snapshots(t)
    listed = snapshots.select(F.concat(F.lit("s3://lake/stage/"), "snapshot").alias("path")).distinct()
    loaded = snapshots.filter(F.col("o_orderdate") < F.lit("2000-02-10").cast("timestamp_ntz"))
    part = F.concat(F.lit("s3a://lake/stage/"), "snapshot", F.lit("/part-00000.parquet"))
    return new_snapshots(listed, loaded.select(part.alias("source_file")))


@query(
    "lineage_columns",
    """SELECT o_orderkey, 'orders.parquet' AS source_file, 'run-1' AS bronze_run_id,
              TIMESTAMP '2026-09-05 10:30:00' AS bronze_ingestion_timestamp FROM orders""",
)
def lineage_columns(t):
    lined = with_lineage(t.orders, "run-1", RUN_TS)
    return lined.select(
        "o_orderkey",
        path_name(normalise_path(F.col("source_file"))).alias("source_file"),
        "bronze_run_id",
        F.col("bronze_ingestion_timestamp").cast("timestamp_ntz").alias("bronze_ingestion_timestamp"),
    )


@query(
    "append_evolve",
    """SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS segment
       FROM supplier UNION ALL SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def append_evolve(t):
    old = t.supplier.selectExpr("s_name AS name", "s_nationkey AS nationkey", "s_acctbal AS acctbal")
    new = t.customer.selectExpr(
        "c_mktsegment AS segment", "c_acctbal AS acctbal", "c_name AS name", "c_nationkey AS nationkey"
    )
    return old.unionByName(new, allowMissingColumns=True)


@query(
    "high_water_mark",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderpriority = '1-URGENT'
                            AND o_orderdate < TIMESTAMP '2000-06-01')""",
)
def high_water_mark(t):
    loaded = t.orders.filter(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") < F.lit("2000-06-01").cast("timestamp_ntz"))
    )
    return read_increment(t.orders, loaded, "o_orderdate").select("o_orderkey", "o_orderdate")


@query(
    "run_log_rollup",
    """SELECT event_type AS table_name, CASE WHEN value > 60 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
              count(*) AS n_runs, sum(CASE WHEN value > 60 THEN 0 ELSE user_id END)::BIGINT AS records_written,
              round(max(value), 4) AS longest_seconds, max(ts) AS last_run
       FROM events GROUP BY ALL""",
)
def run_log_rollup(t):
    failed = F.col("value") > 60
    runs = t.events.select(
        F.col("event_type").alias("table_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, 0).otherwise(F.col("user_id")).alias("records_written"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("finished_at"),
    )
    return runs.groupBy("table_name", "status").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("records_written").alias("records_written"),
        F.round(F.max("duration_seconds"), 4).alias("longest_seconds"),
        F.max("finished_at").alias("last_run"),
    )


@query(
    "stream_file_ingest",
    """SELECT event_type, count(*) AS n_events, sum(user_id)::BIGINT AS user_sum FROM events GROUP BY ALL""",
)
def stream_file_ingest(t):
    """Land the events, ingest them as a stream, run the stream again without new files."""
    root = new_path(t.spark, "stream")
    land_snapshot(t.events, root, "events", RUN_TS, date_column="ts")
    store = TableStore(t.spark, f"{root}/bronze")
    schema = stamp(t.events, "events", RUN_TS, "unknown").schema
    for _ in range(2):
        ingest_new_files(store, f"{root}/events", schema, "events", f"{root}/checkpoint", RUN_TS)
    return store.read("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("user_id").alias("user_sum")
    )
