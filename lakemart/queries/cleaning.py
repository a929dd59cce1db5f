"""Text and value cleaning over whole columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart.functions import text as tx
from lakemart.functions import values as v
from lakemart.functions.dates import in_rolling_window
from lakemart.queries.registry import query

# DuckDB has no NFKD; for Latin letters this is the same fold.
_FOLD = r"regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')"
_TITLE = (
    "array_to_string(list_transform(string_split({0}, ' '), "
    "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '_')"
)


def _normalised(name: str) -> str:
    """SQL twin of ``normalise_text``."""
    titled = _TITLE.format(_FOLD.format(f"trim({name}, ' ')"))
    return f"CASE WHEN {name} IS NULL OR trim({name}, ' ') = '' OR {name} = 'NA' THEN {name} ELSE {titled} END"


def _bracketed(expr: str) -> str:
    braces = rf"regexp_replace({expr}, '\{{([^}}]*)\}}', '[\1]', 'g')"
    return rf"regexp_replace({braces}, '\(([^)]*)\)', '[\1]', 'g')"


@query("strip_accents", f"SELECT doc_id, {_FOLD.format('text')} AS text FROM documents")
def strip_accents(t):
    return t.documents.select("doc_id", tx.strip_accents(F.col("text")).alias("text"))


@query(
    "normalise_text",
    f"""SELECT doc_id, {_normalised('text')} AS text, {_normalised('lang')} AS lang,
               {_normalised('source')} AS source
        FROM (SELECT doc_id, text, CASE WHEN lang = 'de' THEN 'NA' ELSE lang END AS lang,
                     CASE WHEN lang = 'fr' THEN '  ' ELSE source END AS source
              FROM documents)""",
)
def normalise_text(t):
    docs = t.documents.select(
        "doc_id",
        "text",
        F.when(F.col("lang") == "de", "NA").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("lang") == "fr", "  ").otherwise(F.col("source")).alias("source"),
    )
    return tx.normalise_columns(docs, ["text", "lang", "source"])


def _labelled(expr: str) -> str:
    for token, label in tx.SYMBOL_LABELS:
        expr = f"replace({expr}, '{token}', '{label}')"
    return _bracketed(expr)


_ABILITY = "'({T}: Add {' || upper(substr(lang, 1, 1)) || '}.) {' || source || '} ' || text"


@query("symbol_labels", f"SELECT doc_id, {_labelled(_ABILITY)} AS text FROM documents")
def symbol_labels(t):
    initial = F.upper(F.substring("lang", 1, 1))
    ability = F.concat(
        F.lit("({T}: Add {"), initial, F.lit("}.) {"), "source", F.lit("} "), "text"
    )
    return t.documents.select("doc_id", tx.symbol_labels(ability).alias("text"))


@query(
    "bracket_text",
    f"""SELECT doc_id, {_bracketed("'{' || source || '} (' || lang || ') ' || text")} AS text
        FROM documents""",
)
def bracket_text(t):
    noted = F.concat(F.lit("{"), "source", F.lit("} ("), "lang", F.lit(") "), "text")
    return t.documents.select("doc_id", tx.bracket_text(noted).alias("text"))


@query(
    "symbol_count",
    """SELECT doc_id, CAST(CASE WHEN text IS NULL OR text = 'NA' THEN 0
              ELSE length(regexp_replace(upper(text), '[^WUBRG]', '', 'g')) END AS INTEGER) AS n_symbols
       FROM documents""",
)
def symbol_count(t):
    return t.documents.select("doc_id", tx.symbol_count(F.col("text")).alias("n_symbols"))


@query(
    "list_category",
    """SELECT p_partkey, CASE WHEN colours = 'Colorless' THEN 'Colorless'
              WHEN len(string_split(colours, ',')) = 2 THEN 'Dual Color'
              WHEN len(string_split(colours, ',')) >= 3 THEN 'Multicolor' ELSE 'Mono' END AS category
       FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'Colorless' WHEN p_size < 20 THEN p_type
                    WHEN p_size < 30 THEN p_type || ', ' || p_brand
                    ELSE p_type || ', ' || p_brand || ', ' || p_name END AS colours FROM part)""",
)
def list_category(t):
    size = F.col("p_size")
    colours = (
        F.when(size < 10, "Colorless")
        .when(size < 20, F.col("p_type"))
        .when(size < 30, F.concat_ws(", ", "p_type", "p_brand"))
        .otherwise(F.concat_ws(", ", "p_type", "p_brand", "p_name"))
    )
    return t.part.select("p_partkey", tx.list_category(colours).alias("category"))


@query(
    "strip_list_marks",
    """SELECT p_partkey, p_type || ', ' || p_brand AS entries FROM part""",
)
def strip_list_marks(t):
    entries = v.json_text_list(F.array("p_type", "p_brand"))
    return t.part.select("p_partkey", tx.strip_list_marks(entries).alias("entries"))


_TYPE_LINE = """CASE WHEN p_size < 5 THEN NULL WHEN p_size < 8 THEN '  '
    WHEN p_size < 20 THEN 'Legendary Planeswalker — ' || p_name
    WHEN p_size < 35 THEN p_type || ' — ' || p_name || ' — ' || p_brand ELSE ' ' || p_type END"""


@query(
    "split_head_tail",
    f"""SELECT p_partkey,
               CASE WHEN line IS NULL OR trim(line, ' ') = '' THEN 'NA'
                    WHEN lower(line) LIKE '%planeswalker%' THEN 'Planeswalker'
                    WHEN instr(line, '—') > 0 THEN trim(substr(line, 1, instr(line, '—') - 1), ' ')
                    ELSE trim(line, ' ') END AS head,
               CASE WHEN line IS NULL OR trim(line, ' ') = '' THEN 'NA'
                    WHEN lower(line) LIKE '%planeswalker%' THEN line
                    WHEN instr(line, '—') > 0 THEN trim(substr(line, instr(line, '—') + 1), ' ')
                    ELSE 'NA' END AS tail
        FROM (SELECT p_partkey, {_TYPE_LINE} AS line FROM part)""",
)
def split_head_tail(t):
    head, tail = tx.split_head_tail(F.expr(_TYPE_LINE))
    return t.part.select("p_partkey", head.alias("head"), tail.alias("tail"))


_SEGMENT = """CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN ''
    WHEN 'HOUSEHOLD' THEN '   ' ELSE ' ' || c_mktsegment || ' ' END"""


@query(
    "blank_default",
    f"""SELECT c_custkey, CASE WHEN s IS NULL OR s = '' THEN 'NA' ELSE trim(s, ' ') END AS strict,
               coalesce(nullif(trim(s, ' '), ''), 'NA') AS trimmed
        FROM (SELECT c_custkey, {_SEGMENT} AS s FROM customer)""",
)
def blank_default(t):
    segment = F.expr(_SEGMENT)
    return t.customer.select(
        "c_custkey",
        v.blank_to_default(segment).alias("strict"),
        v.trimmed_blank_to_default(segment).alias("trimmed"),
    )


@query(
    "null_default",
    """SELECT c_custkey, coalesce(nullif(c_nationkey, 3), 0) AS nationkey,
              coalesce(nullif(c_mktsegment, 'BUILDING'), '0') AS segment FROM customer""",
)
def null_default(t):
    return t.customer.select(
        "c_custkey",
        v.null_default(F.nullif(F.col("c_nationkey"), F.lit(3)), 0).alias("nationkey"),
        v.null_default(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "0").alias("segment"),
    )


@query(
    "code_upper_join",
    """SELECT c_custkey, n_name, n_regionkey FROM customer
       JOIN nation ON upper('nation_' || c_nationkey) = upper(lower(n_name))""",
)
def code_upper_join(t):
    members = t.customer.select(
        "c_custkey", F.upper(F.concat(F.lit("nation_"), F.col("c_nationkey"))).alias("code")
    )
    sets = t.nation.withColumn("code", F.upper(F.lower("n_name")))
    return members.join(sets, "code").select("c_custkey", "n_name", "n_regionkey")


@query(
    "code_translate",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'Visita' WHEN 'purchase' THEN 'Compra'
              ELSE event_type END AS event_type FROM events""",
)
def code_translate(t):
    labels = {"view": "Visita", "purchase": "Compra"}
    return t.events.select(
        "event_id", v.code_translate(F.col("event_type"), labels).alias("event_type")
    )


@query(
    "content_key",
    """SELECT conv_id, turn, sha256(coalesce(role, '') || '|' || coalesce(CAST(turn AS VARCHAR), '')
              || '|' || coalesce(text, '')) AS content_key
       FROM (SELECT conv_id, turn, nullif(role, 'system') AS role, text FROM conversations)""",
)
def content_key(t):
    role = F.nullif(F.col("role"), F.lit("system"))
    return t.conversations.select(
        "conv_id", "turn", v.content_key(role, F.col("turn"), F.col("text")).alias("content_key")
    )


_PRICE = """CASE o_orderstatus WHEN 'F' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS {text}) || '.25'
    WHEN 'O' THEN o_orderpriority ELSE '' END"""


@query(
    "parse_prices",
    f"""SELECT o_orderkey, CAST(TRY_CAST(p AS FLOAT) AS DOUBLE) AS price
        FROM (SELECT o_orderkey, {_PRICE.format(text='VARCHAR')} AS p FROM orders)""",
)
def parse_prices(t):
    price = v.parse_float(F.expr(_PRICE.format(text="STRING")))
    return t.orders.select("o_orderkey", price.cast("double").alias("price"))


_DATE = """CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS {text})
    WHEN 'O' THEN 'not a date' ELSE '' END"""


@query(
    "parse_dates",
    f"""SELECT o_orderkey, TRY_CAST(d AS DATE) AS order_date,
               TRY_CAST(d || ' 10:30:00' AS TIMESTAMP) AS order_time
        FROM (SELECT o_orderkey, {_DATE.format(text='VARCHAR')} AS d FROM orders)""",
)
def parse_dates(t):
    text = F.expr(_DATE.format(text="STRING"))
    stamp = v.parse_timestamp(F.concat(text, F.lit(" 10:30:00")))
    return t.orders.select(
        "o_orderkey",
        v.parse_date(text).alias("order_date"),
        stamp.cast("timestamp_ntz").alias("order_time"),
    )


@query(
    "tolerant_cast",
    """SELECT p_partkey, TRY_CAST(raw AS INTEGER) AS value,
              CASE WHEN TRY_CAST(raw AS INTEGER) IS NULL THEN raw END AS kept_text
       FROM (SELECT p_partkey, CASE WHEN p_size < 25 THEN CAST(p_size AS VARCHAR) ELSE p_brand END AS raw
             FROM part)""",
)
def tolerant_cast(t):
    raw = F.when(F.col("p_size") < 25, F.col("p_size").cast("string")).otherwise(F.col("p_brand"))
    value, kept = v.tolerant_cast(raw, "int")
    return t.part.select("p_partkey", value.alias("value"), kept.alias("kept_text"))


# Renamed columns, semantic prefixes on the left.
_NAMES = {
    "ID_ITEM": "p_partkey",
    "NME_ITEM": "p_name",
    "COD_MARCA": "p_brand",
    "QTD_TAMANHO": "p_size",
}


@query(
    "rename_project",
    f"SELECT {', '.join(f'{old} AS {new}' for new, old in _NAMES.items())} FROM part",
)
def rename_project(t):
    return t.part.select(*[F.col(old).alias(new) for new, old in _NAMES.items()])


@query(
    "optional_column",
    """SELECT p_partkey, p_brand AS brand, CAST(NULL AS VARCHAR) AS oracle_id,
              CAST(NULL AS BOOLEAN) AS online_only FROM part""",
)
def optional_column(t):
    part = t.part
    return part.select(
        "p_partkey",
        v.optional_column(part, "p_brand", "string").alias("brand"),
        v.optional_column(part, "oracle_id", "string").alias("oracle_id"),
        v.optional_column(part, "online_only", "boolean").alias("online_only"),
    )


@query(
    "column_family",
    f"""SELECT p_partkey, {', '.join(f'CAST(NULL AS VARCHAR) AS booster_{i}' for i in range(20))}
        FROM part""",
)
def column_family(t):
    return t.part.select("p_partkey", *v.column_family("booster", 20))


@query(
    "rolling_window",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 60 MONTH""",
)
def rolling_window(t):
    recent = in_rolling_window(F.col("o_orderdate"), dt.date(2001, 8, 1), 60)
    return t.orders.filter(recent).select("o_orderkey", "o_orderdate")
