"""Null rules, tolerant parsing, keys and lookups as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import NA


def blank_to_default(c: Column, default: str = NA) -> Column:
    """NULL or '' gives the default, anything else is trimmed (all spaces gives '')."""
    return F.when(c.isNull() | (c == ""), default).otherwise(F.trim(c))


def trimmed_blank_to_default(c: Column, default: str = NA) -> Column:
    """NULL, '' or only spaces gives the default."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def empty_to_default(c: Column, default: str = NA) -> Column:
    """NULL or '' gives the default, anything else is untouched."""
    return F.when(c.isNull() | (c == ""), default).otherwise(c)


def null_default(c: Column, default) -> Column:
    return F.coalesce(c, F.lit(default))


def parse_date(c: Column) -> Column:
    return c.try_cast("date")


def parse_timestamp(c: Column) -> Column:
    """A text without a date is NULL; Spark alone would add today's date to a time."""
    text = c.cast("string")
    return F.when(text.rlike(r"^\s*\d{4}"), c.try_cast("timestamp"))


def parse_float(c: Column) -> Column:
    """A text that does not parse costs an exception, so one that cannot be a number is not tried."""
    possible = c.cast("string").rlike(r"(?i)\d|inf|nan|true|false")
    return F.when(possible, c.try_cast("float"))


def widen_float(c: Column) -> Column:
    """Whole numbers to float, NULL kept."""
    return c.cast("float")


def tolerant_cast(c: Column, data_type: str) -> tuple[Column, Column]:
    """The typed value, and the text of what would not cast."""
    typed = c.try_cast(data_type)
    return typed, F.when(typed.isNull(), c.cast("string"))


def code_translate(c: Column, mapping: dict[str, str]) -> Column:
    """Translate known codes; unknown ones pass through."""
    out = c
    for code, label in mapping.items():
        out = F.when(c == code, label).otherwise(out)
    return out


def content_key(*parts: Column, separator: str = "|") -> Column:
    """SHA-256 over the joined parts, NULL counted as ''."""
    return F.sha2(
        F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256
    )


def optional_column(df: DataFrame, name: str, data_type: str) -> Column:
    """The column when the DataFrame has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(data_type)


def column_family(prefix: str, size: int, data_type: str = "string") -> list[Column]:
    """Typed NULL columns ``prefix_0 .. prefix_{size-1}``."""
    return [F.lit(None).cast(data_type).alias(f"{prefix}_{i}") for i in range(size)]


def face_value(key: str, faces: str = "card_faces") -> Column:
    """Root value unless it is NULL, else the first face's value."""
    return F.coalesce(F.col(key), F.get(F.col(faces), F.lit(0))[key])


def _json_scalar(c: Column) -> Column:
    wrapped = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_text_list(c: Column) -> Column:
    """Array of text as JSON with ``", "`` between the entries."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(c, _json_scalar), ", "), F.lit("]")
    )


def json_text_map(c: Column) -> Column:
    """Map of text as JSON with ``": "`` and ``", "``."""
    entries = F.transform(
        F.map_entries(c),
        lambda e: F.concat(_json_scalar(e["key"]), F.lit(": "), _json_scalar(e["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
