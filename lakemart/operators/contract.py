"""Schema contract of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCKING = ("undocumented", "documented_missing")
BREAKING = ("removed", "retyped")


class ContractViolation(Exception):
    """The batch breaks the table's contract; not a key violation on purpose."""


def field_types(schema: StructType) -> dict[str, str]:
    """{column: simple type}; nullability does not count."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def compare_fields(
    current: dict[str, str], incoming: dict[str, str], documented: list[str] | None = None
) -> list[tuple[str, str, str | None, str | None]]:
    """(column, kind, current type, incoming type) for every difference.

    An empty ``current`` is a first load: nothing to differ from.
    """
    found = []
    for name in sorted(set(current) | set(incoming)):
        old, new = current.get(name), incoming.get(name)
        if current and old is None:
            found.append((name, "added", None, new))
        elif new is None:
            found.append((name, "removed", old, None))
        elif current and old != new:
            found.append((name, "retyped", old, new))
    if documented is not None:
        found += [(c, "undocumented", None, incoming[c]) for c in sorted(set(incoming) - set(documented))]
        found += [(c, "documented_missing", None, None) for c in sorted(set(documented) - set(incoming))]
    return found


def check_contract(
    table: str,
    current: StructType | None,
    incoming: StructType,
    documented: list[str] | None = None,
    allow_break: bool = False,
) -> list[str]:
    """Names of added columns; raises with all blocking differences at once.

    ``allow_break`` lets removed and retyped columns pass, never a batch whose
    columns differ from the documented ones.
    """
    diff = compare_fields(field_types(current) if current else {}, field_types(incoming), documented)
    blocking = BLOCKING if allow_break else BLOCKING + BREAKING
    problems = [
        f"{kind} {name}" + (f" ({old} -> {new})" if kind == "retyped" else "")
        for name, kind, old, new in diff
        if kind in blocking
    ]
    if problems:
        raise ContractViolation(f"contract of {table} broken: " + "; ".join(problems))
    return [name for name, kind, _, _ in diff if kind == "added"]


def _long(df: DataFrame, columns: dict[str, Column], key: str, value: str) -> DataFrame:
    """One aggregate over ``df``, one row per named aggregate."""
    names = list(columns)
    return df.agg(*[columns[n].alias(n) for n in names]).unpivot([], names, key, value)


def schema_diff(current: DataFrame, incoming: DataFrame, documented=None) -> DataFrame:
    """The differences with how much data each one touches.

    ``current_values`` and ``incoming_values`` count the non-NULL values of the
    column on each side: what a removal would lose, what an addition would bring.
    """
    session = current.sparkSession
    diff = compare_fields(field_types(current.schema), field_types(incoming.schema), documented)
    kinds = session.createDataFrame(
        diff, "column_name string, kind string, current_type string, incoming_type string"
    )
    touched = {name for name, *_ in diff}

    def filled(df: DataFrame, value: str) -> DataFrame:
        columns = {c: F.count(F.col(c)) for c in df.columns if c in touched}
        if not columns:
            return session.createDataFrame([], f"column_name string, {value} bigint")
        return _long(df, columns, "column_name", value)

    return kinds.join(filled(current, "current_values"), "column_name", "left").join(
        filled(incoming, "incoming_values"), "column_name", "left"
    )


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Project to the contract: cast what has another type, NULL for what is missing."""
    have = field_types(df.schema)

    def column(field):
        kind = field.dataType.simpleString()
        if field.name not in have:
            return F.lit(None).cast(kind).alias(field.name)
        if have[field.name] == kind:
            return F.col(field.name)
        return F.col(field.name).try_cast(kind).alias(field.name)

    return df.select(*[column(f) for f in contract.fields])


def cast_failures(df: DataFrame, contract: StructType) -> DataFrame:
    """Values per retyped column that would not survive the cast, in one scan."""
    have = field_types(df.schema)
    columns = {}
    for field in contract.fields:
        kind = field.dataType.simpleString()
        if have.get(field.name, kind) != kind:
            c = F.col(field.name)
            columns[field.name] = F.count_if(c.isNotNull() & c.try_cast(kind).isNull())
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, failures bigint")
    return _long(df, columns, "column_name", "failures")


def retype(df: DataFrame, wanted: StructType, table: str = "table") -> DataFrame:
    """``df`` with the types that its columns have in ``wanted``; raises rather than lose values."""
    fields = {f.name: f for f in wanted.fields}
    return conform_batch(df, StructType([fields.get(f.name, f) for f in df.schema.fields]), table)


def conform_batch(df: DataFrame, contract: StructType, table: str = "batch") -> DataFrame:
    """``conform``, but raise when a cast would lose values, saying how many."""
    broken = [r for r in cast_failures(df, contract).collect() if r.failures]
    if broken:
        counts = ", ".join(f"{r.column_name}={r.failures}" for r in broken)
        raise ContractViolation(f"{table}: values that do not cast: {counts}")
    return conform(df, contract)
