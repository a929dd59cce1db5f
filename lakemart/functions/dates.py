"""Windows and partition columns; the as-of date is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def release_cutoff(as_of: dt.date, years_back: int = 5) -> dt.date:
    """1 January of the year ``years_back`` before ``as_of``."""
    return dt.date(as_of.year - years_back, 1, 1)


def in_release_window(c: Column, as_of: dt.date, years_back: int = 5) -> Column:
    """True from the cut-off on; NULL dates fall out of a filter on it."""
    return c >= F.lit(release_cutoff(as_of, years_back))


def in_rolling_window(c: Column, as_of: dt.date, months: int = 60) -> Column:
    return c >= F.add_months(F.lit(as_of), -months)


def partition_columns(
    c: Column, fallback: dt.date | None = None, names=("partition_year", "partition_month")
) -> dict[str, Column]:
    """Year and month of a date; NULL falls back to the run date when one is given."""
    year, month = F.year(c), F.month(c)
    if fallback is not None:
        year = F.coalesce(year, F.lit(fallback.year))
        month = F.coalesce(month, F.lit(fallback.month))
    return {names[0]: year, names[1]: month}
