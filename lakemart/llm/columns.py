"""Rows of tables whose columns can have any name and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def named(name: str) -> Column:
    """The column of that name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def hashable(df: DataFrame) -> list[Column]:
    """All columns of ``df`` in a form that hashing and grouping take: maps as JSON texts."""
    out = []
    for field in df.schema.fields:
        value = named(field.name)
        kind = field.dataType.simpleString()
        out.append(F.to_json(F.struct(value)) if "map<" in kind or "variant" in kind else value)
    return out
