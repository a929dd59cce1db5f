"""Consumer questions on a mart, as plain DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_average(amount: Column) -> Column:
    """Average over six decimals, more than prices have: a decimal sum does not depend on
    the order of the rows, and sub-cent prices count in full."""
    return F.sum(amount.cast("decimal(28,6)")).cast("double") / F.count(amount)


def appreciation(fact: DataFrame, groups: list[str], member: str, time: str, price: str) -> DataFrame:
    """Average change from each member's first to last quote, per group."""
    quotes = fact.filter(F.col(price).isNotNull())
    # NULL is the least time, so a quote without one is the first, and the last only if all are.
    quote = F.struct(time, price)
    ends = quotes.groupBy(*groups, member).agg(F.min(quote).alias("_first"), F.max(quote).alias("_last"))
    change = ends.select(*groups, (F.col("_last")[price] - F.col("_first")[price]).alias("_change"))
    return change.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_members"),
        exact_average(F.col("_change")).alias("avg_change"),
    )


def price_trend(fact: DataFrame, time: str, price: str) -> DataFrame:
    """Monthly average and its change; the window runs over months, not quotes."""
    monthly = fact.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        exact_average(F.col(price)).alias("avg_price")
    )
    previous = F.lag("avg_price").over(Window.orderBy("year", "month"))
    return monthly.withColumn("change", F.col("avg_price") - previous)


def by_child_volume(dim: DataFrame, key: str, children: str, k: int) -> DataFrame:
    """The ``k`` members with most child rows."""
    return dim.select(key, children).orderBy(F.col(children).desc(), F.col(key)).limit(k)


def canonical_rollup(fact: DataFrame, canonical: str, member: str, price: str) -> DataFrame:
    """Quotes per canonical id, whatever id they were made under."""
    return fact.groupBy(canonical).agg(
        F.count_distinct(member).alias("n_ids"),
        F.count(F.lit(1)).alias("n_quotes"),
        F.round(F.max(price), 4).alias("top_price"),
    )


def variant_spread(fact: DataFrame, group: str, member: str, price: str) -> DataFrame:
    """Cheapest and dearest variant per group."""
    per_variant = fact.groupBy(group, member).agg(F.max(price).alias("p"))
    return per_variant.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.round(F.min("p"), 4).alias("cheapest"),
        F.round(F.max("p"), 4).alias("dearest"),
    )
