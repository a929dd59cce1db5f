"""Data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of a report.
NO_CHECKS = "sem checagens"
INFO, FAILED, OK = "INFO", "FALHA", "OK"


class DataQualityError(RuntimeError):
    """A count passed its limit; ``results`` holds every count."""

    def __init__(self, message: str, results: dict[str, int]):
        super().__init__(message)
        self.results = results


@dataclass(frozen=True)
class Check:
    """A counting aggregate; ``limit`` None only reports."""

    name: str
    count: Column
    limit: int | None = 0


def any_null(*names: str) -> Column:
    out = F.col(names[0]).isNull()
    for name in names[1:]:
        out = out | F.col(name).isNull()
    return out


def any_negative(*names: str) -> Column:
    return F.least(*names) < 0 if len(names) > 1 else F.col(names[0]) < 0


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_null) of the listed columns, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_null")


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, n, check_limit, level), all checks in one scan of ``df``."""
    return judged(df.agg(*[F.coalesce(c.count.cast("bigint"), F.lit(0)).alias(c.name) for c in checks]), checks)


def judged(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """The report of one row of counts, a column for each check."""
    limits = F.create_map(
        *[x for c in checks for x in (F.lit(c.name), F.lit(c.limit).cast("bigint"))]
    )
    long = counts.unpivot([], [c.name for c in checks], "check_name", "n")
    limit = limits[F.col("check_name")]
    return long.withColumn("check_limit", limit).withColumn(
        "level",
        F.when(F.col("check_limit").isNull(), INFO)
        .when(F.col("n") > F.col("check_limit"), FAILED)
        .otherwise(OK),
    )


def enforce(report: DataFrame, label: str) -> dict[str, int]:
    """Counts by check name; raises after all checks when one passed its limit."""
    rows = report.collect()
    results = {r.check_name: r.n for r in rows}
    failed = [f"{r.check_name}={r.n} (limit {r.check_limit})" for r in rows if r.level == FAILED]
    if failed:
        raise DataQualityError(f"{label}: " + "; ".join(failed), results)
    return results


def unmatched_ids(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """One row, ``n_ids``: distinct ids of ``df`` without a match in ``other``.

    Both sides are reduced to distinct ids before the join, so no id is hot in it.
    """
    ids = df.select(key).filter(F.col(key).isNotNull()).distinct()
    missing = ids.join(other.select(key).distinct(), key, "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("n_ids"))


def summary_text(results: dict[str, int]) -> str:
    """``k=v, k=v``"""
    return ", ".join(f"{k}={v}" for k, v in results.items()) if results else NO_CHECKS
