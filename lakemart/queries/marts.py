"""Dimension, fact, data quality and consumer questions.

Stand-ins on the analytic tables: customers are the members, nations and regions
the lookups, events the child rows, orders the quotes and the renames.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart.examples import questions as q
from lakemart.operators.chain import attach_canonical, resolve_chain
from lakemart.operators.dimension import (
    Lookup,
    build_dim,
    build_fact,
    changed_ids,
    changed_prints,
    child_summary,
    incremental_slice,
    latest_event,
    member_prints,
    missing_members,
)
from lakemart.operators.keyed import upsert
from lakemart.operators.quality import Check, any_negative, any_null, run_checks, unmatched_ids
from lakemart.plans.lineage import cut_lineage
from lakemart.queries.registry import query
from lakemart.queries.tables import _edges, _WALK


CUTOFF = dt.datetime(2000, 6, 1)
UNKNOWN = "Nao_Identificado"


@query(
    "child_preagg",
    """SELECT user_id, count(*) AS n_events, max(ts) AS last_event FROM events GROUP BY user_id""",
)
def child_preagg(t):
    return child_summary(t.events, "user_id", "ts", "n_events", "last_event")


@query(
    "latest_event",
    """SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (
           PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_event_query(t):
    return latest_event(t.events, "user_id", ["ts", "event_id"], ["ts", "event_id", "event_type"])


_DIM = """ev AS (SELECT user_id, count(*) AS n_events, max(ts) AS last_event FROM events {when} GROUP BY 1),
    mig AS (SELECT o_custkey AS old_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS new_id
            FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2001-01-01' GROUP BY 1),
    dim AS (SELECT c_custkey, c_mktsegment, c_nationkey, coalesce(n_name, 'Nao_Identificado') AS nation,
                   coalesce(r_name, 'Nao_Identificado') AS region, coalesce(n_events, 0) AS n_events,
                   coalesce(last_event, TIMESTAMP '1001-01-01') AS last_event,
                   coalesce(new_id, c_custkey) AS canonical_id,
                   CASE WHEN old_id IS NOT NULL THEN 'Sim' ELSE 'Nao' END AS migrated
            FROM customer LEFT JOIN (SELECT nullif(n_nationkey, 7) AS n_nationkey, n_name, nullif(r_name, 'ASIA') AS r_name
                 FROM nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey
            LEFT JOIN ev ON c_custkey = user_id LEFT JOIN mig ON c_custkey = old_id)"""
DIM_SQL = _DIM.format(when="")
FACT_SQL = """fact AS (SELECT dim.*, o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS quote_year
                       FROM orders JOIN dim ON o_custkey = c_custkey)"""


def dimension(t, events=None):
    sets = (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.nullif(F.col("n_nationkey"), F.lit(7)).alias("n_nationkey"), "n_name", F.nullif(F.col("r_name"), F.lit("ASIA")).alias("r_name"))
    )
    children = child_summary(
        t.events if events is None else events, "user_id", "ts", "n_events", "last_event"
    )
    renames = t.orders.filter("o_orderstatus = 'F' AND o_orderdate > TIMESTAMP_NTZ '2001-01-01'")
    moved = latest_event(
        renames, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"]
    )
    sentinel = F.lit("1001-01-01").cast("timestamp_ntz")
    driver = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    return build_dim(
        driver,
        [
            Lookup(
                sets,
                "c_nationkey",
                "n_nationkey",
                {"n_name": "nation", "r_name": "region"},
                {"nation": F.lit(UNKNOWN), "region": F.lit(UNKNOWN)},
                # A handful of nations is broadcast, so no nation can be too much for one task.
                hot=[],
            ),
            Lookup(
                children,
                "c_custkey",
                "user_id",
                {"n_events": "n_events", "last_event": "last_event"},
                {"n_events": F.lit(0), "last_event": sentinel},
                driver_unique=True,
            ),
            Lookup(
                moved,
                "c_custkey",
                "o_custkey",
                {"o_orderkey": "canonical_id"},
                {"canonical_id": F.col("c_custkey")},
                ("migrated", "Sim", "Nao"),
                driver_unique=True,
            ),
        ],
    )


def quotes(t):
    return t.orders.select(
        F.col("o_custkey").alias("c_custkey"),
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        F.year("o_orderdate").alias("quote_year"),
    )


def fact(t):
    return build_fact(quotes(t), dimension(t), "c_custkey")


@query("dim_build", f"WITH {DIM_SQL} SELECT * FROM dim")
def dim_build(t):
    return dimension(t)


@query("fact_build", f"WITH {DIM_SQL}, {FACT_SQL} SELECT * FROM fact")
def fact_build(t):
    return fact(t)


# The stored dimension knows only the events before the last day of the data.
_OLD = "WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY"
_OLD_DIM = (
    _DIM.format(when=_OLD).replace("ev AS", "ev0 AS").replace("LEFT JOIN ev ON", "LEFT JOIN ev0 ON")
    .replace("mig AS", "mig0 AS").replace("LEFT JOIN mig ON", "LEFT JOIN mig0 ON").replace("dim AS", "dim0 AS")
)
_CHANGED = "changed AS (SELECT DISTINCT c_custkey FROM (SELECT * FROM dim EXCEPT ALL SELECT * FROM dim0))"


def stored_dimension(t):
    last = t.events.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("ts")).first()[0]
    return dimension(t, t.events.filter(F.col("ts") < F.lit(last).cast("timestamp_ntz")))


def both_dimensions(t):
    """The fresh and the stored dimension, each computed once."""
    return cut_lineage(dimension(t), "dim"), cut_lineage(stored_dimension(t), "dim")


@query("dim_changed_ids", f"WITH {DIM_SQL}, {_OLD_DIM}, {_CHANGED} SELECT c_custkey FROM changed")
def dim_changed_ids(t):
    return changed_ids(dimension(t), stored_dimension(t), "c_custkey")


@query("dim_changed_prints", f"WITH {DIM_SQL}, {_OLD_DIM}, {_CHANGED} SELECT c_custkey FROM changed")
def dim_changed_prints(t):
    """The same from stored prints of the members."""
    stored = cut_lineage(member_prints(stored_dimension(t), "c_custkey"), "members")
    return changed_prints(member_prints(dimension(t), "c_custkey"), stored, "c_custkey")


def _fresh_facts(t, fresh, stored):
    changed = cut_lineage(changed_ids(fresh, stored, "c_custkey"), "changed")
    new = incremental_slice(quotes(t), changed, "c_custkey", "o_orderdate", CUTOFF, "quote_year")
    return build_fact(new, fresh, "c_custkey", hot=[])


@query(
    "fact_incremental",
    f"""WITH {DIM_SQL}, {_OLD_DIM}, {_CHANGED}, {FACT_SQL} SELECT * FROM fact
        WHERE o_orderdate > TIMESTAMP '2000-06-01' OR c_custkey IN (SELECT c_custkey FROM changed)""",
)
def fact_incremental(t):
    return _fresh_facts(t, *both_dimensions(t))


@query("propagate_end_to_end", f"WITH {DIM_SQL}, {FACT_SQL} SELECT * FROM fact")
def propagate_end_to_end(t):
    """The stored fact with old attributes, brought up to date; equals a full rebuild."""
    until = F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz")
    fresh_dim, stored_dim = both_dimensions(t)
    # Both sides are read from written tables or scans, so adaptive execution can split a hot member.
    stored = build_fact(quotes(t).filter(until), stored_dim, "c_custkey", hot=[])
    return upsert(stored, _fresh_facts(t, fresh_dim, stored_dim), ["c_custkey", "o_orderkey"])


@query(
    "orphan_rows",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
           SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def orphan_rows(t):
    known = t.customer.filter("c_acctbal >= 0")
    return missing_members(t.orders, known, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query(
    "dq_orphans",
    """SELECT count(DISTINCT o_custkey) AS n_ids FROM orders LEFT JOIN
           (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey WHERE c_custkey IS NULL""",
)
def dq_orphans(t):
    known = t.customer.filter("c_acctbal >= 0").withColumnRenamed("c_custkey", "o_custkey")
    return unmatched_ids(t.orders, known, "o_custkey")


@query(
    "dq_parent_without_child",
    """SELECT count(DISTINCT c_custkey) AS n_ids FROM customer LEFT JOIN
           (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01') ON c_custkey = o_custkey
       WHERE o_custkey IS NULL""",
)
def dq_parent_without_child(t):
    recent = t.orders.filter("o_orderdate > TIMESTAMP_NTZ '2001-01-01'")
    return unmatched_ids(
        t.customer, recent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"
    )


def _checks() -> list[Check]:
    return [
        Check("fk_null", F.count_if(F.col("region_key").isNull())),
        Check("null_residual", F.count_if(any_null("nation", "c_mktsegment", "migrated")), 5),
        Check("negative_value", F.count_if(any_negative("o_totalprice", "margin"))),
        Check("lookup_not_found", F.count_if(F.col("nation") == UNKNOWN), None),
        Check("migrated_members", F.count_if(F.col("migrated") == "Sim"), None),
    ]


@query(
    "dq_report",
    f"""WITH {DIM_SQL}, {FACT_SQL}, f AS (SELECT *, nullif(region, 'EUROPE') AS region_key,
             CASE WHEN o_totalprice > 1000 THEN o_totalprice - 2000 END AS margin FROM fact),
        n AS (SELECT 'fk_null' AS check_name, count(*) FILTER (region_key IS NULL) AS n, 0 AS check_limit FROM f
        UNION ALL SELECT 'null_residual', count(*) FILTER (nation IS NULL OR c_mktsegment IS NULL
                         OR migrated IS NULL), 5 FROM f
        UNION ALL SELECT 'negative_value', count(*) FILTER (o_totalprice < 0 OR margin < 0), 0 FROM f
        UNION ALL SELECT 'lookup_not_found', count(*) FILTER (nation = 'Nao_Identificado'), NULL FROM f
        UNION ALL SELECT 'migrated_members', count(*) FILTER (migrated = 'Sim'), NULL FROM f)
        SELECT check_name, n, CAST(check_limit AS BIGINT) AS check_limit, CASE WHEN check_limit IS NULL
               THEN 'INFO' WHEN n > check_limit THEN 'FALHA' ELSE 'OK' END AS level FROM n""",
)
def dq_report(t):
    price = F.col("o_totalprice")
    rows = fact(t).withColumns(
        {
            "region_key": F.nullif(F.col("region"), F.lit("EUROPE")),
            "margin": F.when(price > 1000, price - 2000),
        }
    )
    return run_checks(rows, _checks())


@query(
    "audit_summary",
    """WITH e AS (SELECT event_type AS table_name, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS run, count(*) AS processed,
                         count(*) FILTER (value > 100) AS high, count(*) FILTER (user_id = 0) AS zero
                  FROM events GROUP BY ALL)
       SELECT table_name, run, processed, 'high=' || high || ', zero=' || zero AS dq_result,
              CASE WHEN high > 90 THEN 'FALHA_DQ' ELSE 'SUCESSO' END AS status FROM e""",
)
def audit_summary(t):
    """One audit line per run: events of a type and month stand for a run's rows."""
    runs = t.events.groupBy(
        F.col("event_type").alias("table_name"),
        (F.year("ts") * 100 + F.month("ts")).alias("run"),
    ).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("value") > 100).alias("high"),
        F.count_if(F.col("user_id") == 0).alias("zero"),
    )
    result = F.concat_ws(
        ", ", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in ("high", "zero")]
    )
    return runs.select(
        "table_name",
        "run",
        "processed",
        result.alias("dq_result"),
        F.when(F.col("high") > 90, "FALHA_DQ").otherwise("SUCESSO").alias("status"),
    )


@query(
    "appreciation",
    f"""WITH {DIM_SQL}, {FACT_SQL}, m AS (SELECT nation, c_mktsegment, c_custkey,
             arg_min(o_totalprice, (o_orderdate, o_totalprice)) AS first,
             arg_max(o_totalprice, (o_orderdate, o_totalprice)) AS last FROM fact GROUP BY ALL)
        SELECT nation, c_mktsegment, count(*) AS n_members,
               CAST(sum(CAST(last - first AS DECIMAL(28, 6))) AS DOUBLE) / count(*) AS avg_change
        FROM m GROUP BY ALL""",
)
def appreciation(t):
    return q.appreciation(
        fact(t), ["nation", "c_mktsegment"], "c_custkey", "o_orderdate", "o_totalprice"
    )


@query(
    "price_trend",
    """WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, 
                         CAST(sum(CAST(o_totalprice AS DECIMAL(28, 6))) AS DOUBLE) / count(*) AS a
                  FROM orders GROUP BY ALL)
       SELECT year, month, a AS avg_price, a - lag(a) OVER (ORDER BY year, month) AS change
       FROM m""",
)
def price_trend(t):
    return q.price_trend(t.orders, "o_orderdate", "o_totalprice")


@query(
    "by_child_volume",
    f"WITH {DIM_SQL} SELECT c_custkey, n_events FROM dim ORDER BY n_events DESC, c_custkey LIMIT 20",
)
def by_child_volume(t):
    return q.by_child_volume(dimension(t), "c_custkey", "n_events", 20)


@query(
    "canonical_rollup",
    f"""{_WALK} SELECT coalesce(canonical, o_custkey) AS canonical_id, count(DISTINCT o_custkey) AS n_ids,
                count(*) AS n_quotes, round(max(o_totalprice), 4) AS top_price
        FROM orders LEFT JOIN resolved ON o_custkey = old GROUP BY 1""",
)
def canonical_rollup(t):


    named = attach_canonical(t.orders, resolve_chain(_edges(t)), "o_custkey", "canonical_id")
    return q.canonical_rollup(named, "canonical_id", "o_custkey", "o_totalprice")


@query(
    "variant_spread",
    """WITH v AS (SELECT p_name, l_partkey, max(l_extendedprice) AS p FROM lineitem
                  JOIN part ON l_partkey = p_partkey GROUP BY ALL)
       SELECT p_name, count(*) AS n_variants, round(min(p), 4) AS cheapest, round(max(p), 4) AS dearest
       FROM v GROUP BY p_name""",
)
def variant_spread(t):
    """Lines are reduced to one price per part before names are joined."""
    dearest = t.lineitem.groupBy("l_partkey").agg(F.max("l_extendedprice").alias("price"))
    named = dearest.join(
        t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    )
    return q.variant_spread(named, "p_name", "l_partkey", "price")
