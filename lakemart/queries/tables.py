"""Contracts, dedupe, upsert, keys and id chains."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.chain import attach_canonical, latest_edges, resolve_chain
from lakemart.operators.contract import cast_failures, conform, conform_batch, schema_diff
from lakemart.operators.keyed import (
    dedup_any,
    dedup_latest,
    duplicated_keys,
    key_report,
    keyed_side,
    same_key,
    upsert,
)
from lakemart.plans.lineage import cut_lineage
from lakemart.queries.registry import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_TIES = (
    "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, "
    "l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)


def _first_per_key(order: str, source: str = "lineitem", columns: str = "*") -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


@query(
    "dedup_latest",
    _first_per_key(f"l_shipdate DESC NULLS LAST, {_LINE_TIES}", columns="* EXCLUDE (rn)"),
)
def dedup_latest_query(t):
    return dedup_latest(t.lineitem, LINE_KEY, "l_shipdate")


_NULLED = """(SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END AS l_shipdate)
              FROM lineitem)"""


@query(
    "dedup_nulls_last",
    _first_per_key(f"l_shipdate DESC NULLS LAST, {_LINE_TIES}", _NULLED, "* EXCLUDE (rn)"),
)
def dedup_nulls_last(t):
    dated = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    return dedup_latest(t.lineitem.withColumn("l_shipdate", dated), LINE_KEY, "l_shipdate")


@query(
    "dedup_any",
    _first_per_key(
        _LINE_TIES.replace(" DESC", "") + ", l_shipdate", columns="* EXCLUDE (rn)"
    ),
)
def dedup_any_query(t):
    return dedup_any(t.lineitem, LINE_KEY)


@query(
    "nullsafe_join",
    """WITH e AS (SELECT event_id, nullif(event_type, 'error') AS k, value FROM events),
            s AS (SELECT k, count(*) AS n_events, round(max(value), 4) AS top FROM e GROUP BY k)
       SELECT event_id, e.k AS event_kind, n_events, top FROM e JOIN s ON e.k IS NOT DISTINCT FROM s.k""",
)
def nullsafe_join(t):
    events = t.events.select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_kind"), "value"
    )
    summary = events.groupBy("event_kind").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.max("value"), 4).alias("top")
    )
    side = keyed_side(summary, ["event_kind"], ["n_events", "top"])
    return events.join(side, same_key(["event_kind"])).select(
        "event_id", "event_kind", "n_events", "top"
    )


@query(
    "upsert",
    """WITH b AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, round(o_totalprice * 2, 4) AS o_totalprice,
                         o_orderdate, o_orderpriority, 'new' AS note
                  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
       SELECT *, CAST(NULL AS VARCHAR) AS note FROM orders
       WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderkey NOT IN (SELECT o_orderkey FROM b)
       UNION ALL BY NAME SELECT * FROM b""",
)
def upsert_query(t):
    """Earlier orders, upserted with later, overlapping and altered ones; a new column comes in."""
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'")
    batch = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'").withColumns(
        {
            "o_orderstatus": F.lit("X"),
            "o_totalprice": F.round(F.col("o_totalprice") * 2, 4),
            "note": F.lit("new"),
        }
    )
    return upsert(target, batch, ["o_orderkey"])


_UPDATED = """b AS (SELECT l_orderkey, l_linenumber, round(max(l_quantity) + 1, 4) AS quantity
                    FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)"""


@query(
    "upsert_composite",
    f"""WITH a AS (SELECT nullif(l_orderkey, 7) AS l_orderkey, l_linenumber, round(min(l_quantity), 4) AS quantity
                   FROM lineitem GROUP BY ALL),
             {_UPDATED.replace('SELECT l_orderkey', 'SELECT nullif(l_orderkey, 7) AS l_orderkey')}
        SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey IS NOT DISTINCT FROM a.l_orderkey
               AND b.l_linenumber IS NOT DISTINCT FROM a.l_linenumber) UNION ALL SELECT * FROM b""",
)
def upsert_composite(t):
    """Two-column key with NULL parts: a NULL key replaces a NULL key."""
    lines = t.lineitem.withColumn("l_orderkey", F.nullif(F.col("l_orderkey"), F.lit(7)))
    target = (
        lines.groupBy(*LINE_KEY)
        .agg(F.round(F.min("l_quantity"), 4).alias("quantity"))
    )
    batch = (
        lines.filter("l_linestatus = 'F'")
        .groupBy(*LINE_KEY)
        .agg(F.round(F.max("l_quantity") + 1, 4).alias("quantity"))
    )
    return upsert(target, batch, LINE_KEY)


@query(
    "key_gate",
    """SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (status IS NULL) AS status,
              count(*) - count(DISTINCT struct_pack(a := o_orderkey, b := status)) AS duplicates
       FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)""",
)
def key_gate(t):
    keyed = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    )
    return key_report(keyed, ["o_orderkey", "status"])


@query(
    "key_gate_dups",
    """SELECT count(*) FILTER (l_orderkey IS NULL) AS l_orderkey,
              count(*) FILTER (l_linenumber IS NULL) AS l_linenumber,
              count(*) - count(DISTINCT struct_pack(a := l_orderkey, b := l_linenumber)) AS duplicates
       FROM lineitem""",
)
def key_gate_dups(t):
    return key_report(t.lineitem, LINE_KEY)


@query(
    "batch_dup_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def batch_dup_keys(t):
    return duplicated_keys(t.lineitem, LINE_KEY)


@query(
    "schema_diff",
    """SELECT 'code' AS column_name, 'retyped' AS kind, 'bigint' AS current_type, 'string' AS incoming_type,
              (SELECT count(o_orderkey) FROM orders) AS current_values,
              (SELECT count(l_returnflag) FROM lineitem) AS incoming_values
       UNION ALL SELECT 'priority', 'removed', 'string', NULL,
              (SELECT count(nullif(o_orderpriority, '5-LOW')) FROM orders), NULL
       UNION ALL SELECT 'discount', 'added', NULL, 'double', NULL,
              (SELECT count(nullif(l_discount, 0)) FROM lineitem)
       UNION ALL SELECT 'discount', 'undocumented', NULL, 'double', NULL,
              (SELECT count(nullif(l_discount, 0)) FROM lineitem)
       UNION ALL SELECT 'status', 'documented_missing', NULL, NULL, NULL, NULL""",
)
def schema_diff_query(t):
    """A batch of lines against a table of orders, with the values each difference touches."""
    current = t.orders.select(
        F.col("o_orderkey").alias("code"),
        F.col("o_orderdate").alias("day"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )
    incoming = t.lineitem.select(
        F.col("l_returnflag").alias("code"),
        F.col("l_shipdate").alias("day"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )
    return schema_diff(current, incoming, documented=["code", "day", "status"])


_PART_TEXT = """(SELECT p_partkey, CASE WHEN p_size < 30 THEN CAST(p_size AS {text}) ELSE p_type END AS size,
    CASE WHEN p_size < 10 THEN CAST(p_partkey AS {text}) ELSE p_name END AS code, p_name AS name FROM part)"""
_CONTRACT = "p_partkey bigint, size int, code bigint, name string, origin string"


@query(
    "conform_batch",
    """SELECT p_partkey, p_size AS size, p_partkey AS code, p_name AS name,
              CAST(NULL AS VARCHAR) AS origin FROM part""",
)
def conform_batch_query(t):
    """A batch of texts that all cast."""
    part = t.part.selectExpr(
        "p_partkey", "CAST(p_size AS STRING) AS size", "CAST(p_partkey AS STRING) AS code", "p_name AS name"
    )
    return conform_batch(part, StructType.fromDDL(_CONTRACT), "part")


@query(
    "conform",
    f"""SELECT p_partkey, TRY_CAST(size AS INTEGER) AS size, TRY_CAST(code AS BIGINT) AS code, name,
               CAST(NULL AS VARCHAR) AS origin FROM {_PART_TEXT.format(text='VARCHAR')}""",
)
def conform_query(t):
    return conform(_part_as_text(t), StructType.fromDDL(_CONTRACT))


@query(
    "cast_failures",
    f"""WITH p AS {_PART_TEXT.format(text='VARCHAR')}
        SELECT 'size' AS column_name, count(*) FILTER (TRY_CAST(size AS INTEGER) IS NULL AND size IS NOT NULL)
               AS failures FROM p
        UNION ALL SELECT 'code', count(*) FILTER (TRY_CAST(code AS BIGINT) IS NULL AND code IS NOT NULL) FROM p""",
)
def cast_failures_query(t):
    return cast_failures(_part_as_text(t), StructType.fromDDL(_CONTRACT))


def _part_as_text(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(size < 30, size.cast("string")).otherwise(F.col("p_type")).alias("size"),
        F.when(size < 10, F.col("p_partkey").cast("string")).otherwise(F.col("p_name")).alias("code"),
        F.col("p_name").alias("name"),
    )


# Renames derived from the orders: each customer's finished orders point to another
# customer; the graph is full of long paths and cycles.
_EDGES = """events AS (SELECT o_custkey AS old_id, CASE WHEN o_orderstatus = 'F'
                         THEN o_orderkey % (SELECT count(*) FROM customer) END AS new_id,
                         o_orderdate, o_orderkey FROM orders),
            edges AS (SELECT old_id AS old, arg_max(new_id, (o_orderdate, o_orderkey)) AS new
                      FROM events WHERE new_id IS NOT NULL GROUP BY old_id)"""
_WALK = f"""WITH RECURSIVE {_EDGES},
            walk AS (SELECT old, old AS node, [old] AS path, 0 AS hops FROM edges
                     UNION ALL
                     SELECT w.old, e.new, list_append(w.path, e.new), w.hops + 1
                     FROM walk w JOIN edges e ON w.node = e.old
                     WHERE w.hops < 10 AND NOT list_contains(w.path, e.new)),
            resolved AS (SELECT old, arg_max(node, hops) AS canonical, max(hops) AS hops FROM walk GROUP BY old)"""


def _rename_events(t):
    members = t.customer.count()
    target = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % F.lit(members))
    return t.orders.select(
        F.col("o_custkey").alias("old_id"), target.alias("new_id"), "o_orderdate", "o_orderkey"
    )


def _edges(t):
    return cut_lineage(_latest(t), "edges")


def _latest(t):
    return latest_edges(_rename_events(t), "old_id", "new_id", ["o_orderdate", "o_orderkey"])


@query("edge_latest", f"WITH {_EDGES} SELECT old, new FROM edges")
def edge_latest(t):
    return _latest(t)


@query("chain_resolve", f"{_WALK} SELECT old, canonical, hops FROM resolved")
def chain_resolve(t):
    return resolve_chain(_edges(t))


@query(
    "chain_cycles",
    f"""{_WALK} SELECT r.old, r.canonical, CASE WHEN r.hops = 10 THEN 'limit' WHEN e.old IS NULL THEN 'end'
                       ELSE 'cycle' END AS stopped
        FROM resolved r LEFT JOIN edges e ON r.canonical = e.old""",
)
def chain_cycles(t):
    """Why each walk stopped: hop limit, no further edge, or an id it had seen."""
    edges = _edges(t)
    onward = edges.select(F.col("old").alias("_at"))
    resolved = resolve_chain(edges).join(onward, F.col("canonical") == F.col("_at"), "left")
    stopped = (
        F.when(F.col("hops") == 10, "limit").when(F.col("_at").isNull(), "end").otherwise("cycle")
    )
    return resolved.select("old", "canonical", stopped.alias("stopped"))


@query(
    "chain_attach",
    f"""{_WALK} SELECT o_orderkey, old_id, coalesce(r.canonical, old_id) AS canonical_id
        FROM events LEFT JOIN resolved r ON old_id = r.old""",
)
def chain_attach(t):
    events = _rename_events(t)
    resolved = resolve_chain(_edges(t))
    return attach_canonical(events, resolved, "old_id", "canonical_id").select(
        "o_orderkey", "old_id", "canonical_id"
    )
