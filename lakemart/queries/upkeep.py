"""Tables kept up to date from what changed: late rows, moved rows, counters, references, walks.

Each query stores tables, changes them and gives back what the incremental job makes of it; its
SQL twin computes the same from the final rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators.chain import ended_at, latest_edges, walks
from lakemart.operators.closure import update_closure
from lakemart.operators.dimension import build_fact
from lakemart.operators.quality import Check
from lakemart.plans.counters import check_table, heavy_keys, newest
from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.lineage import cut_lineage, new_path
from lakemart.plans.mart import MartSpec, QuoteSource, refresh_mart
from lakemart.plans.reconcile import differing_partitions, row_prints
from lakemart.plans.refcounts import reference_counts, unmatched_counts
from lakemart.plans.store import TableStore
from lakemart.queries.marts import CUTOFF, DIM_SQL, FACT_SQL, dimension, quotes
from lakemart.queries.registry import query
from lakemart.queries.tables import _WALK, _rename_events
from lakemart.streaming.keyed_stream import upsert_stream


def _store(t, name: str) -> TableStore:
    return TableStore(t.spark, new_path(t.spark, name))


#: Urgent orders reach the quotes after the fact was first made, whatever their date.
_LATE = "o_orderpriority = '1-URGENT'"


@query("late_quotes", f"WITH {DIM_SQL}, {FACT_SQL} SELECT * FROM fact")
def late_quotes(t):
    """A fact that late quotes of all years reach without a rebuild, and withdrawn ones leave."""
    store = _store(t, "late")
    spec = MartSpec(
        "dim", "fact", "c_custkey", "o_orderdate", "quote_year", "o_orderdate", ("quote_year",),
        lambda quoted, dim, hot: build_fact(quoted, dim, "c_custkey", hot),
        keys=("o_orderkey",),
        quote_columns=("c_custkey", "o_orderkey", "o_orderdate", "o_totalprice"),
        quote_partitions=("quote_year",),
    )
    late = t.orders.filter(_LATE).select("o_orderkey")
    wrong = quotes(t).filter(F.col("o_orderdate") > F.lit(CUTOFF).cast("timestamp_ntz"))
    first = quotes(t).join(late, "o_orderkey", "left_anti")
    # Withdrawn later: these orders are in twice, under another number.
    first = first.unionByName(wrong.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    dim, source = cut_lineage(dimension(t), "dim"), QuoteSource(store, "quotes")
    for table in (first, quotes(t)):
        store.overwrite(table, "quotes", ["quote_year"])
        refresh_mart(store, spec, dim, store.read("quotes"), source=source)
    return store.read("fact")


@query(
    "partition_prints",
    f"""WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
                     count(*) AS n, count(*) FILTER ({_LATE}) AS late FROM orders GROUP BY ALL)
        SELECT y, m FROM a WHERE late > 0""",
)
def partition_prints(t):
    """Months whose orders differ once the urgent ones are in."""
    month = {"y": F.year("o_orderdate"), "m": F.month("o_orderdate")}
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    orders = t.orders.withColumns(month)
    now, then = (row_prints(rows, ["y", "m"], columns) for rows in (orders, orders.filter(f"NOT {_LATE}")))
    return differing_partitions(now, then, ["y", "m"])


_MOVED = "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END"


@query(
    "upsert_moved",
    f"""SELECT o_orderkey, {_MOVED} AS o_orderdate, CAST(year({_MOVED}) AS INTEGER) AS y, CASE WHEN o_orderstatus = 'P'
               THEN 'moved' ELSE 'first' END AS load FROM orders""",
)
def upsert_moved(t):
    """Orders by year; pending ones move to another year, found by zones and Bloom filters."""
    store = _store(t, "moved")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")

    def dated(rows, load):
        return rows.select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"), F.lit(load).alias("load"))

    later = orders.filter("o_orderstatus = 'P'").withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 400 DAYS"))
    for batch in (dated(orders, "first"), dated(later, "moved")):
        save_keyed(batch, store, "orders", ["o_orderkey"], partition_by=["y"])
    return store.read("orders")


def _two_loads(t, name: str) -> TableStore:
    """Orders by year: first those before the cut-off, then the later ones with all finished ones again."""
    store = _store(t, name)
    orders = t.orders.withColumn("y", F.year("o_orderdate"))
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")
    for batch in (orders.filter(until), orders.filter(~until | (F.col("o_orderstatus") == "F"))):
        save_keyed(batch, store, "orders", ["o_orderkey"], partition_by=["y"], key_decides_partition=True)
        # Kept from the first load on, so the second one only adds what it touched.
        yield store


def _order_checks() -> list[Check]:
    return [
        Check("finished", F.count_if(F.col("o_orderstatus") == "F")),
        Check("cheap", F.count_if(F.col("o_totalprice") < 1000), 10),
        Check("all", F.count(F.lit(1)), None),
    ]


@query(
    "dq_counters",
    """WITH n AS (SELECT 'finished' AS check_name, count(*) FILTER (o_orderstatus = 'F') AS n, 0 AS check_limit FROM orders
           UNION ALL SELECT 'cheap', count(*) FILTER (o_totalprice < 1000), 10 FROM orders
           UNION ALL SELECT 'all', count(*), NULL FROM orders)
       SELECT check_name, n, CAST(check_limit AS BIGINT) AS check_limit, CASE WHEN check_limit IS NULL THEN 'INFO'
              WHEN n > check_limit THEN 'FALHA' ELSE 'OK' END AS level FROM n""",
)
def dq_counters(t):
    """Checks of a stored table from counters per partition."""
    for store in _two_loads(t, "counters"):
        report = check_table(store, "orders", _order_checks())
    return report


@query(
    "dq_references",
    """SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS without_order,
              (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
               WHERE c_acctbal >= 0)) - 0 AS without_customer,
              (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)) AS known_without_order""",
)
def dq_references(t):
    """Ids that one table has and the other lacks, from reference counts kept over two loads."""
    for store in _two_loads(t, "references"):
        ordered = reference_counts(store, "orders", "o_custkey")
    counts = []
    for name, rows in (("customers", t.customer), ("known", t.customer.filter("c_acctbal >= 0"))):
        store.overwrite(rows.select("c_custkey", "c_mktsegment"), name, ["c_mktsegment"])
        counts.append(unmatched_counts(reference_counts(store, name, "c_custkey"), ordered))
    everyone, known = (c.select(*(F.col(x).alias(f"{p}_{x}") for x in c.columns)) for p, c in zip("ak", counts))
    # One row each.
    both = everyone.withColumn("one", F.lit(1)).join(known.withColumn("one", F.lit(1)), "one")
    return both.select(
        F.col("a_left_only").alias("without_order"),
        F.col("k_right_only").alias("without_customer"),
        F.col("k_left_only").alias("known_without_order"),
    )


@query("stored_mark", "SELECT max(o_orderdate) AS mark, max(o_orderkey) AS top_key FROM orders")
def stored_mark(t):
    """The newest date and key of a stored table, from marks per partition."""
    for store in _two_loads(t, "marks"):
        mark, top = (newest(store, "orders", c) for c in ("o_orderdate", "o_orderkey"))
    return t.spark.createDataFrame([(mark, top)], "mark timestamp_ntz, top_key long")


@query(
    "stored_hot_keys",
    "SELECT event_type AS hot FROM events GROUP BY 1 HAVING count(*) > (SELECT count(*) FROM events) / 64.0",
)
def stored_hot_keys(t):
    """Keys that hold most rows of a stored table, from sketches per partition."""
    store = _store(t, "sketches")
    store.overwrite(t.events.withColumn("m", F.month("ts")), "events", ["m"])
    hot = heavy_keys(store, "events", "event_type")
    return t.spark.createDataFrame([(key,) for key in hot], "hot string")


@query("chain_incremental", f"{_WALK} SELECT old, canonical, hops FROM resolved")
def chain_incremental(t):
    """Walks of the renames up to the cut-off, brought up to date by the later ones."""
    events = _rename_events(t)
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")

    def edges(rows):
        return cut_lineage(latest_edges(rows, "old_id", "new_id", ["o_orderdate", "o_orderkey"]), "edges")

    before, after = edges(events.filter(until)), edges(events)
    paths = cut_lineage(walks(before), "walks")
    return ended_at(update_closure(paths, before, after, cut=cut_lineage))


@query(
    "stream_upsert",
    """SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS y, CASE
           WHEN o_orderstatus = 'F' OR o_orderdate > TIMESTAMP '2000-06-01' THEN 'later' ELSE 'first' END AS load
       FROM orders""",
)
def stream_upsert(t):
    """Two appends to a Bronze table, each brought into a keyed one by a stream of micro-batches."""
    store = _store(t, "stream")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", F.year("o_orderdate").alias("y"))
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")
    first = orders.filter(until).withColumn("load", F.lit("first"))
    later = orders.filter(~until | (F.col("o_orderstatus") == "F")).withColumn("load", F.lit("later"))
    for batch in (first, later):
        store.append(batch.drop("o_orderstatus"), "bronze")
        upsert_stream(
            store, "bronze", store, "orders", ["o_orderkey"], f"{store.root}/checkpoint", partition_by=["y"],
            order_by="o_orderdate", key_decides_partition=True,
        )
    return store.read("orders")
