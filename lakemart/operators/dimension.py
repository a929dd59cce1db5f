"""Current dimension and incremental fact."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.skew import hot_keys, spread_join


@dataclass(frozen=True)
class Lookup:
    """A table with one row per ``on`` value, joined to the driver on ``driver_key``.

    ``take`` names the columns to bring, ``defaults`` what stands for a missing one.
    ``driver_unique`` says that the driver has one row per key too, so none is hot;
    ``hot`` lists the keys of very many driver rows when known, else they are looked for.
    """

    df: DataFrame
    driver_key: str
    on: str
    take: dict[str, str]
    defaults: dict[str, Column] = field(default_factory=dict)
    found_flag: tuple[str, str, str] | None = None
    driver_unique: bool = False
    hot: list | None = None


def child_summary(children: DataFrame, parent: str, date: str, count_as: str, latest_as: str) -> DataFrame:
    """Rows and latest date per parent, so that the later join cannot fan out."""
    return children.groupBy(parent).agg(
        F.count(F.lit(1)).alias(count_as), F.max(date).alias(latest_as)
    )


def latest_event(events: DataFrame, key: str, order_by: list[str], take: list[str]) -> DataFrame:
    """The newest event per key, ties by the later ``order_by`` columns."""
    newest = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in [*order_by, *take]))
    ranked = events.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter("_rank = 1").select(key, *take)


def build_dim(driver: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Driver rows left-joined to every lookup, missing values replaced by defaults."""
    out = driver
    for i, lookup in enumerate(lookups):
        key, columns = f"_k{i}", {f"_k{i}_{new}": old for old, new in lookup.take.items()}
        side = lookup.df.select(
            F.col(lookup.on).alias(key), *[F.col(old).alias(tmp) for tmp, old in columns.items()]
        )
        if lookup.driver_unique:
            out = out.join(side, F.col(lookup.driver_key) == F.col(key), "left")
        else:
            hot = hot_keys(driver, lookup.driver_key) if lookup.hot is None else lookup.hot
            out = spread_join(out, side, lookup.driver_key, key, "left", hot)
        new = {}
        for old, name in lookup.take.items():
            value = F.col(f"_k{i}_{name}")
            if name in lookup.defaults:
                value = F.coalesce(value, lookup.defaults[name])
            new[name] = value
        if lookup.found_flag:
            name, yes, no = lookup.found_flag
            new[name] = F.when(F.col(key).isNotNull(), yes).otherwise(no)
        out = out.withColumns(new).drop(key, *columns)
    return out


def build_fact(quotes: DataFrame, dim: DataFrame, key: str, hot: list | None = None) -> DataFrame:
    """Quotes of known members with the members' attributes.

    ``hot`` lists members with very many quotes when known, else they are looked for, which computes the
    quotes twice more: give it where they are not a table's own rows. An empty list leaves hot members to
    adaptive execution, which splits them where both sides are shuffled for the join.
    """
    members = dim.withColumnRenamed(key, "_member")
    return spread_join(quotes, members, key, "_member", hot=hot).drop("_member")


def changed_ids(fresh: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Ids of new or altered members; deleted ones do not show. Ids are unique in both."""
    old = stored.select(*(F.col(c).alias(f"_old_{c}") for c in fresh.columns), F.lit(True).alias("_known"))
    same = F.col("_known").isNotNull()
    for c in fresh.columns:
        same &= F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    joined = fresh.join(old, F.col(key).eqNullSafe(F.col(f"_old_{key}")), "left")
    return joined.filter(~same).select(key)


def row_print(df: DataFrame) -> Column:
    """SHA-256 of a row: each column with its type and length before it, NULL as a dash."""
    parts = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        plain = F.to_json(F.struct(f.name)) if "<" in kind else F.col(f.name).cast("string")
        value = F.when(F.col(f.name).isNotNull(), plain)
        sized = F.concat(F.lit(f"{kind}:"), F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def member_prints(dim: DataFrame, key: str) -> DataFrame:
    """(key, row_print): all that a later run needs to know of the members."""
    return dim.select(key, row_print(dim).alias("row_print"))


def changed_prints(fresh: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Ids of new or altered members, from the ``member_prints`` of both; as ``changed_ids`` of the rows."""
    old = stored.select(F.col(key).alias("_old_key"), F.col("row_print").alias("_old_print"))
    joined = fresh.join(old, F.col(key).eqNullSafe(F.col("_old_key")), "left")
    return joined.filter(~F.col("row_print").eqNullSafe(F.col("_old_print"))).select(key)


def incremental_slice(
    quotes: DataFrame,
    changed: DataFrame,
    key: str,
    time: str,
    cutoff,
    year_column: str | None = None,
) -> DataFrame:
    """Quotes after the cut-off, and all older quotes of changed members.

    Two disjoint branches instead of an OR: each keeps its own predicate, so the
    first prunes partitions and reads only new rows, the second is a semi join.
    """
    bound = F.lit(cutoff).cast(quotes.schema[time].dataType)
    new = quotes.filter(F.col(time) > bound)
    old = quotes.filter((F.col(time) <= bound) | F.col(time).isNull())
    if year_column:
        year = F.col(year_column)
        new = new.filter(year >= cutoff.year)
        old = old.filter((year <= cutoff.year) | year.isNull())
    return new.unionByName(old.join(changed, key, "left_semi"))


def missing_members(df: DataFrame, source: DataFrame, key: str, source_key: str) -> DataFrame:
    """Rows whose key is no longer (or not) in the source."""
    known = source.select(F.col(source_key).alias("_known"))
    return df.join(known, F.col(key) == F.col("_known"), "left_anti")
