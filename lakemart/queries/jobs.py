"""The jobs themselves: they run over the analytic tables and give back what they stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakemart.functions.paths import normalise_path, path_name
from lakemart.operators.contract import ContractViolation
from lakemart.operators.dimension import build_fact
from lakemart.operators.quality import Check, enforce, run_checks
from lakemart.plans.bronze import load_new_snapshots
from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.landing import land_snapshot
from lakemart.plans.lineage import new_path
from lakemart.plans.mart import MartSpec, refresh_mart
from lakemart.plans.runlog import AUDIT_TABLE, RUN_LOG, audit_run, run_logged
from lakemart.plans.store import TableStore
from lakemart.queries.marts import CUTOFF, DIM_SQL, FACT_SQL, dimension, quotes, stored_dimension
from lakemart.queries.registry import query
from lakemart.sources.json_source import rejected_lines, scan_jsonl, scan_pages
from lakemart.sources.snapshots import list_snapshots

RUN_TS = dt.datetime(2026, 9, 5, 10, 30)
LATER = dt.datetime(2026, 9, 6, 10, 30)


def _store(t, name: str) -> TableStore:
    return TableStore(t.spark, new_path(t.spark, name))


@query(
    "json_reject",
    """SELECT event_id, CASE WHEN user_id % 5 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS line
       FROM events WHERE user_id % 5 = 0""",
)
def json_reject(t):
    """Lines cut short, as a scan that fails on them would report."""
    cut = F.expr("substr(props, 1, length(props) - 1)")
    line = F.when(F.col("user_id") % 5 == 0, cut).otherwise(F.col("props"))
    lines = t.events.select("event_id", line.alias("line"))
    return rejected_lines(lines, "line", StructType([StructField("k", IntegerType())]))


_MONTH = """'snapshot=' || strftime(o_orderdate, '%Y_%m') || '_20260905_orders.parquet'"""


@query("bronze_load", f"SELECT o_orderkey, o_custkey, {_MONTH} AS snapshot FROM orders")
def bronze_load(t):
    """Orders landed by month and loaded twice; the second load finds nothing new."""
    store = _store(t, "bronze")
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_day"))
    land_snapshot(orders, f"{store.root}/stage", "orders", RUN_TS, date_column="o_day")
    for load_ts in (RUN_TS, LATER):
        load_new_snapshots(store, f"{store.root}/stage", "orders", load_ts)
    snapshot = path_name(normalise_path(F.col("source_file"))).alias("snapshot")
    return store.read("orders").select("o_orderkey", "o_custkey", snapshot)


@query("snapshot_folders", f"SELECT DISTINCT {_MONTH} AS snapshot, true AS complete FROM orders")
def snapshot_folders(t):
    store = _store(t, "stage")
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_day"))
    land_snapshot(orders, store.root, "orders", RUN_TS, date_column="o_day")
    listed = list_snapshots(t.spark, f"{store.root}/orders")
    return listed.select(path_name(F.col("path")).alias("snapshot"), "complete")


@query(
    "append_table",
    """SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS segment
       FROM supplier UNION ALL SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def append_table(t):
    """Two appends, the second with one more column and in another order."""
    store = _store(t, "append")
    store.append(t.supplier.selectExpr("s_name AS name", "s_nationkey AS nationkey", "s_acctbal AS acctbal"), "names")
    store.append(
        t.customer.selectExpr(
            "c_mktsegment AS segment", "c_acctbal AS acctbal", "c_name AS name", "c_nationkey AS nationkey"
        ),
        "names",
    )
    return store.read("names")


@query(
    "save_keyed_twice",
    """SELECT o_orderkey, o_orderdate, year(o_orderdate)::INTEGER AS y, CASE
           WHEN o_orderstatus = 'F' OR o_orderdate > TIMESTAMP '2000-06-01' THEN 'later' ELSE 'first' END AS load
       FROM orders""",
)
def save_keyed_twice(t):
    """Orders up to the cut-off with each row doubled, then finished and newer ones over them."""
    store = _store(t, "keyed")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", F.year("o_orderdate").alias("y"))
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")
    first = orders.filter(until).withColumn("load", F.lit("first"))
    later = orders.filter(~until | (F.col("o_orderstatus") == "F")).withColumn("load", F.lit("later"))
    for batch in (first.unionAll(first), later):
        save_keyed(
            batch.drop("o_orderstatus"), store, "orders", ["o_orderkey"], "o_orderdate", ["y"]
        )
    return store.read("orders")


@query("mart_refresh", f"WITH {DIM_SQL}, {FACT_SQL} SELECT * FROM fact")
def mart_refresh(t):
    """A mart built from old members and quotes, then refreshed; equals one built at once."""
    store = _store(t, "mart")
    spec = MartSpec(
        "dim", "fact", "c_custkey", "o_orderdate", "quote_year", "o_orderdate", ("quote_year",),
        lambda quoted, dim, hot: build_fact(quoted, dim, "c_custkey", hot),
        keys=("o_orderkey",),
    )
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")
    refresh_mart(store, spec, stored_dimension(t), quotes(t).filter(until))
    refresh_mart(store, spec, dimension(t), quotes(t))
    return store.read("fact")


_COUNTS = "SELECT '{0}' AS table_name, count(*) AS n FROM {0}"
_RUNS = " UNION ALL ".join(_COUNTS.format(name) for name in ("orders", "customer", "supplier"))


@query(
    "ledger_rows",
    f"""SELECT table_name, CASE WHEN table_name = 'supplier' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               n AS records_read, CASE WHEN table_name = 'supplier' THEN 0 ELSE n END AS records_written,
               CASE WHEN table_name = 'supplier' THEN 'supplier: not today' END AS error FROM ({_RUNS})""",
)
def ledger_rows(t):
    """The ledger of three runs, the last of which fails."""
    store = _store(t, "ledger")
    for name in ("orders", "customer", "supplier"):

        def job(run):
            run["records_read"] = getattr(t, name).count()
            if name == "supplier":
                raise ValueError("supplier: not today")
            run["records_written"] = run["records_read"]
            return name

        try:
            run_logged(store, name, job, RUN_TS)
        except ValueError:
            # The run's own failure; its row is what is asked for.
            pass
    return store.read(RUN_LOG).select("table_name", "status", "records_read", "records_written", "error")


@query(
    "audit_rows",
    """SELECT 'orders' AS NME_TABELA, count(*) AS QTD_LIDOS, count(*) AS QTD_PROCESSADOS,
              count(*) AS QTD_INSERIDOS_ATUALIZADOS, 'SUCESSO' AS DESC_STATUS FROM orders
       UNION ALL SELECT 'events', count(*), 0, 0, 'FALHA_DQ' FROM events""",
)
def audit_rows(t):
    """The audit rows of a run that passes and of one whose check fails."""
    store = _store(t, "audit")
    checks = {
        "orders": Check("negative", F.count_if(F.col("o_totalprice") < 0)),
        "events": Check("rows", F.count(F.lit(1))),
    }
    for name, check in checks.items():
        rows = getattr(t, name)
        try:
            with audit_run(store, name) as audit:
                audit.read = rows.count()
                enforce(run_checks(rows, [check]), name)
                audit.processed = audit.read
        except RuntimeError:
            # The failed check; its row is what is asked for.
            pass
    columns = ["NME_TABELA", "QTD_LIDOS", "QTD_PROCESSADOS", "QTD_INSERIDOS_ATUALIZADOS", "DESC_STATUS"]
    return store.read(AUDIT_TABLE).select(*columns)


_EVENT = StructType(
    [
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
        StructField("value", DoubleType()),
        StructField("event_type", StringType()),
    ]
)


@query("json_lines", "SELECT event_id, user_id, value, event_type FROM events")
def json_lines(t):
    """All events written as lines of JSON, compressed, and scanned with their schema."""
    folder = new_path(t.spark, "lines")
    t.events.select(_EVENT.names).write.option("compression", "gzip").json(folder)
    return scan_jsonl(t.spark, folder, _EVENT, spread=True)


_PAGE = 100


@query(
    "json_pages",
    f"""SELECT c_custkey, c_name, c_custkey // {_PAGE} AS page,
               row_number() OVER (PARTITION BY c_custkey // {_PAGE} ORDER BY c_custkey) - 1 AS position FROM customer""",
)
def json_pages(t):
    """Customers as documents of a hundred, each a page of a numbered list, and back."""
    folder = new_path(t.spark, "pages")
    item = F.sort_array(F.collect_list(F.struct("c_custkey", "c_name")))
    pages = t.customer.groupBy(F.expr(f"c_custkey div {_PAGE}").alias("page")).agg(item.alias("data"))
    # Pages are one file each.
    (
        pages.withColumn("has_more", F.lit(False))
        .repartition(F.col("page"))
        .withColumn("document", F.to_json(F.struct("page", "has_more", "data")))
        .select("document", F.lpad(F.col("page").cast("string"), 9, "0").alias("file"))
        .write.partitionBy("file")
        .text(folder)
    )
    rows = scan_pages(t.spark, folder, StructType.fromDDL("c_custkey long, c_name string"))
    return rows.select("c_custkey", "c_name", F.expr(f"c_custkey div {_PAGE}").alias("page"), F.col("_position").cast("long").alias("position"))


@query(
    "bronze_ledger",
    f"""WITH m AS (SELECT count(DISTINCT {_MONTH}) AS files, count(*) AS n FROM orders)
        SELECT 'orders' AS table_name, 'SUCCESS' AS status, files AS files_processed, n AS records_read, n AS records_written FROM m
        UNION ALL SELECT 'orders', 'SUCCESS', 0, 0, 0""",
)
def bronze_ledger(t):
    """The ledger of a load of all snapshots and of one that finds nothing new."""
    store = _store(t, "bronze")
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_day"))
    land_snapshot(orders, f"{store.root}/stage", "orders", RUN_TS, date_column="o_day")
    for load_ts in (RUN_TS, LATER):
        load_new_snapshots(store, f"{store.root}/stage", "orders", load_ts)
    return store.read(RUN_LOG).select("table_name", "status", "files_processed", "records_read", "records_written")


@query(
    "contract_break",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '-x' AS code, year(o_orderdate)::INTEGER AS y FROM orders
       WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), year(o_orderdate)::INTEGER
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def contract_break(t):
    """A batch that retypes a column, refused by the contract and then let in with ``allow_break``."""
    store = _store(t, "contract")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    numbers = orders.select("o_orderkey", F.col("o_custkey").alias("code"), "y")
    finished = orders.filter("o_orderstatus = 'F'")
    texts = finished.select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit("-x")).alias("code"), "y")
    save_keyed(numbers, store, "orders", ["o_orderkey"], partition_by=["y"])
    try:
        save_keyed(texts, store, "orders", ["o_orderkey"], partition_by=["y"])
    except ContractViolation:
        # Refused without leave; nothing was written.
        save_keyed(texts, store, "orders", ["o_orderkey"], partition_by=["y"], allow_break=True)
    return store.read("orders")


@query("overwrite_unkeyed", "SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1")
def overwrite_unkeyed(t):
    """A table without a key is replaced by each save, also by one that reads it."""
    store = _store(t, "unkeyed")
    save_keyed(t.events.select("event_type", "value"), store, "events")
    save_keyed(store.read("events").filter("value > 50"), store, "events")
    return store.read("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
