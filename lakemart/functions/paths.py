"""Snapshot paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_path(c: Column) -> Column:
    """Without URI scheme, cut after the first ``.parquet`` directory."""
    bare = F.regexp_replace(c, r"^.*?://", "")
    return F.regexp_replace(bare, r"\.parquet/(?s:.*)$", ".parquet")


def path_name(c: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(c, "/", -1)


def snapshot_name(year: Column, month: Column, run_date: dt.date, table: str) -> Column:
    """``2021_03_20260905_card_prices.parquet``"""
    return F.concat(
        year.cast("string"),
        F.lit("_"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lit(f"_{run_date:%Y%m%d}_{table}.parquet"),
    )
