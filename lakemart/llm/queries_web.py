"""Registered queries over the web pages table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.merkle import audit
from lakemart.llm.registry import query, table
from lakemart.llm.url_templates import (
    DEPTH,
    DIFFERENCE,
    MIN_PAGES,
    MIN_SHARE,
    PURITY,
    SMOOTHING,
    WILDCARD,
    listed_rule,
    template_verdicts,
    url_parts,
)

# The listed rules.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
#: What is added to the id of a record that a damaged copy holds twice.
EXTRA = 1 << 32


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica with bit rot: by the first byte of the url's MD5, one record in 256 is
    changed (00), one is lost (01), one stands a second time under another id (02)."""
    mark = F.substring(F.md5("url"), 1, 2)
    kept = pages.where(F.coalesce(mark != "01", F.lit(True)))
    rotten = F.when(mark == "00", F.concat("html", F.lit("?"))).otherwise(F.col("html"))
    extra = pages.where(mark == "02").withColumn("page_id", F.col("page_id") + EXTRA)
    return kept.withColumn("html", rotten).unionByName(extra)


_RECORD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = """
    select page_id, sum(n_bytes)::bigint as n_bytes, sha256(concat_ws(':', count(*)::varchar,
        sum(w0)::varchar, sum(w1)::varchar, sum(w2)::varchar, sum(w3)::varchar)) as h
    from (select page_id, strlen(rec) as n_bytes,
            ('0x' || substr(sha256(rec), 1, 16))::ubigint::hugeint as w0,
            ('0x' || substr(sha256(rec), 17, 16))::ubigint::hugeint as w1,
            ('0x' || substr(sha256(rec), 33, 16))::ubigint::hugeint as w2,
            ('0x' || substr(sha256(rec), 49, 16))::ubigint::hugeint as w3
          from (select page_id, {record} as rec from {source}))
    group by page_id
"""
_RECORDS = " || ".join(_RECORD.format(c) for c in ("page_id::varchar", "url", "html"))


@query(
    "op1_warc_merkle",
    f"""
    with copy as (
        select page_id, url, case when substr(md5(url), 1, 2) = '00' then html || '?' else html end as html
        from pages where coalesce(substr(md5(url), 1, 2) <> '01', true)
        union all
        select page_id + {EXTRA}, url, html from pages where substr(md5(url), 1, 2) = '02'
    ),
    a as ({_LEAF.format(record=_RECORDS, source="pages")}),
    b as ({_LEAF.format(record=_RECORDS, source="copy")}),
    both_sides as (
        select coalesce(a.page_id, b.page_id) as page_id, a.n_bytes, a.h as expected, b.h as found
        from a full join b on a.page_id = b.page_id
    ),
    placed as (
        select *, coalesce(sum(n_bytes) over (order by page_id
            rows between unbounded preceding and 1 preceding), 0)::bigint as warc_offset
        from both_sides
    )
    select page_id, case when found is null then 'missing' when expected is null then 'extra'
        else 'corrupt' end as status, warc_offset, n_bytes, expected, found
    from placed where expected is distinct from found
    """,
)
def warc_merkle(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = audit(pages, damaged_copy(pages), "page_id", ["url", "html"])
    return found.withColumnsRenamed({"key": "page_id", "offset": "warc_offset"})


def _template_sql() -> str:
    """The same tree level by level, as common table expressions."""
    parts, node = [], ["host"]
    for d in range(1, DEPTH + 1):
        keys, seg = ", ".join(node), f"seg[{d}]"
        same = " AND ".join(f"r{d - 1}.{c} = f{d}.{c}" for c in node)
        parts += [
            f"c{d} AS (SELECT {keys}, {seg} AS s, count(*) AS n FROM r{d - 1} GROUP BY ALL)",
            f"""f{d} AS (SELECT {keys}, s FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}) AS of_n FROM c{d})
                WHERE s IS NOT NULL AND n >= {MIN_PAGES} AND n >= {MIN_SHARE} * of_n)""",
            f"""r{d} AS (SELECT r{d - 1}.*, CASE WHEN {seg} IS NOT NULL THEN coalesce(f{d}.s, '{WILDCARD}') END AS t{d}
                FROM r{d - 1} LEFT JOIN f{d} ON {same} AND {seg} = f{d}.s)""",
        ]
        node.append(f"t{d}")
    copies = ", ".join(f"t{d} AS m{d}" for d in range(1, DEPTH + 1))
    parts.append(
        f"""s{DEPTH + 1} AS (SELECT {', '.join(node)}, {copies}, count(good)::DOUBLE AS labelled,
            coalesce(sum(good), 0.0) AS g FROM r{DEPTH} GROUP BY ALL)"""
    )
    for d in range(DEPTH, 0, -1):
        above = ", ".join(["host", *(f"m{i}" for i in range(1, d))])
        parts.append(
            f"""s{d} AS (SELECT * EXCLUDE (n, b, o, a) REPLACE (CASE WHEN m{d} IS NULL OR coalesce(
                    abs(b / n - (a - b) / o) > {DIFFERENCE} * sqrt(a / (n + o) * (1 - a / (n + o)) * (1 / n + 1 / o)),
                    false) THEN m{d} ELSE '{WILDCARD}' END AS m{d})
                FROM (SELECT *, nullif(sum(labelled) OVER (PARTITION BY {above}, m{d}), 0) AS n,
                             sum(g) OVER (PARTITION BY {above}, m{d}) AS b,
                             nullif(sum(labelled) OVER (PARTITION BY {above})
                                    - sum(labelled) OVER (PARTITION BY {above}, m{d}), 0) AS o,
                             sum(g) OVER (PARTITION BY {above}) AS a FROM s{d + 1}))"""
        )
    branch = ", ".join(["host", *(f"m{d}" for d in range(1, DEPTH + 1))])
    same = " AND ".join(f"r.{c} IS NOT DISTINCT FROM j.{c}" for c in node)
    rules = sorted(RULES, key=lambda rule: -len(rule[1]))
    fits = [
        (text, action, f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{prefix}')")
        for action, text in rules
        for name, _, prefix in [text.partition("/")]
    ]
    rule = " ".join(f"WHEN {fit} THEN '{text}'" for text, _, fit in fits)
    listed = " ".join(f"WHEN {fit} THEN '{action}'" for _, action, fit in fits)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH b AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
               THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{upper.lower()}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
    lab AS (SELECT doc_id, avg(quality) AS good FROM labels
            WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
    r0 AS (SELECT p.*, good, CASE WHEN path <> '' THEN string_split(regexp_replace(path, '^/', ''), '/') END AS seg
           FROM p LEFT JOIN lab ON TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})[^/0-9]*/?$', 1) AS BIGINT) = doc_id),
    {', '.join(parts)},
    h AS (SELECT host, sum(labelled) AS hl, sum(g) AS hg FROM s1 GROUP BY 1),
    w AS (SELECT coalesce(sum(hg) / nullif(sum(hl), 0), 1.0) AS prior FROM h),
    j AS (SELECT {', '.join(f's1.{c}' for c in node)}, concat_ws('/', {', '.join('s1.' + c for c in branch.split(', '))}) AS template,
                 (sum(g) OVER own + {SMOOTHING} * ((hg + {SMOOTHING} * prior) / (hl + {SMOOTHING})))
                 / (sum(labelled) OVER own + {SMOOTHING}) AS purity
          FROM s1 JOIN h ON s1.host = h.host, w WINDOW own AS (PARTITION BY s1.{branch}))
    SELECT page_id, r.host, path, CASE {rule} END AS rule,
           CASE {listed} ELSE CASE WHEN purity < {PURITY} THEN 'block' ELSE 'allow' END END AS verdict,
           template, purity
    FROM r{DEPTH} AS r JOIN j ON {same}
    """.replace("OR ends_with(host", "OR ends_with(r.host").replace("(host = '", "(r.host = '")


@query("op7_url_templates", _template_sql())
def url_templates(spark: SparkSession, folder: str) -> DataFrame:
    host, path = url_parts(F.col("url"))
    pages = table(spark, folder, "pages").select("page_id", host.alias("host"), path.alias("path"))
    # The document that a page shows is named by the number that ends its path.
    shown = F.regexp_extract("path", r"/([0-9]{1,18})[^/0-9]*/?$", 1).try_cast("long")
    labels = table(spark, folder, "labels").where("quality is not null and doc_id is not null")
    labels = labels.groupBy(F.col("doc_id").alias("_doc")).agg(F.avg("quality").alias("good"))
    labelled = pages.withColumn("_doc", shown).join(labels, "_doc", "left").drop("_doc")
    rule, listed = listed_rule(F.col("host"), F.col("path"), RULES)
    learned = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    return template_verdicts(labelled).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(listed, learned).alias("verdict"),
        "template",
        "purity",
    )
