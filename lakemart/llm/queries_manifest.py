"""Registered query over the manifest of the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.manifest import digest, folded, framed, manifest, proof
from lakemart.llm.registry import query, table

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Levels that the SQL twin has for leaves of a source, and for sources.
_LEVELS = (7, 4)


def _levels_sql(name: str, first: str, group: str, levels: int) -> list[str]:
    """Nodes ``{name}{k}``, runs of 16 of them and the top of each group, level by level."""
    parts = [f"{name}0 AS ({first})"]
    for k in range(levels):
        parts += [
            f"{name}run{k} AS (SELECT {group}, rn // 16 AS rn, array_agg(h ORDER BY rn) AS hs FROM {name}{k} WHERE size > 1 GROUP BY ALL)",
            f"""{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY {group}) AS size
                FROM (SELECT {group}, rn, sha256(array_to_string(hs, '')) AS h FROM {name}run{k}))""",
        ]
    tops = " UNION ALL ".join(f"SELECT {group}, h FROM {name}{k} WHERE size = 1" for k in range(levels + 1))
    return [*parts, f"{name}top AS ({tops})"]


def _walk_sql(name: str, first: str, runs: str, group: str, levels: int, keep: str) -> list[str]:
    """``cur`` and ``own`` folded up a group's runs, ``proof`` gathering the siblings."""
    parts = [f"{name}0 AS ({first})"]
    for k in range(levels):
        at = "w.rn % 16"
        left, right = f"array_to_string(hs[1:({at})], '')", f"array_to_string(hs[({at}) + 2:], '')"
        parts.append(
            f"""{name}{k + 1} AS (SELECT {keep}, w.rn // 16 AS rn,
                CASE WHEN hs IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
                CASE WHEN hs IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
                FROM {name}{k} w LEFT JOIN {runs}run{k} r ON w.{group} IS NOT DISTINCT FROM r.{group} AND w.rn // 16 = r.rn)"""
        )
    return parts


def _framed_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _crc32_sql(text: str) -> str:
    """The CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"


def _manifest_sql() -> str:
    tampered = f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN {_framed_sql(f'translate(text, {_UPPER!r}, {_UPPER.lower()!r})')} END"
    leaves, sources = _LEVELS
    parts = [
        f"leaf AS (SELECT doc_id, source, {_framed_sql('text')} AS leaf, {tampered} AS tampered FROM documents)",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rn,
                             count(*) OVER (PARTITION BY source) AS size FROM leaf)""",
        *_levels_sql("n", "SELECT source, rn, leaf AS h, size FROM placed", "source", leaves),
        *_levels_sql(
            "s",
            "SELECT 0 AS one, source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rn, count(*) OVER () AS size FROM ntop",
            "one",
            sources,
        ),
        *_walk_sql(
            "w",
            "SELECT doc_id, source, leaf, rn, coalesce(tampered, leaf) AS cur, '' AS proof FROM placed",
            "n",
            "source",
            leaves,
            "doc_id, w.source, leaf",
        ),
        *_walk_sql(
            "v",
            f"""SELECT doc_id, leaf, w.cur, w.proof, 0 AS one, s0.h AS subroot, s0.rn FROM w{leaves} w
                JOIN s0 ON w.source IS NOT DISTINCT FROM s0.source""",
            "s",
            "one",
            sources,
            "doc_id, leaf, subroot, w.one",
        ),
    ]
    return f"""WITH {', '.join(parts)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
        FROM v{sources}, stop"""


@query("op11_nested_manifest", _manifest_sql())
def nested_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*_COLUMNS)
    lower = F.translate("text", _UPPER, _UPPER.lower())
    tampered = digest(framed(*(lower if name == "text" else F.col(name) for name in _COLUMNS)))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = manifest(docs, "source", "doc_id", _COLUMNS, {"tampered": F.when(chosen, tampered)})
    given = F.coalesce("tampered", "leaf")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        digest(proof(F.col("path"))).alias("proof_sha256"),
        folded(given, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
