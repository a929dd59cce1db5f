"""Row counts taken on the way, without a job of their own."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RowCount:
    """Counts the rows flowing through ``on(df)`` in the next action that runs it."""

    def __init__(self) -> None:
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("n"))

    @property
    def value(self) -> int:
        try:
            return self._seen.get["n"]
        except Py4JJavaError:
            # The metric is gone when the optimizer proved the input empty.
            return 0


class NullCount:
    """Counts NULLs of some columns the same way; ``value`` has those with any."""

    def __init__(self, columns) -> None:
        self._columns, self._seen = list(columns), Observation()

    def on(self, df: DataFrame) -> DataFrame:
        if not self._columns:
            return df
        counts = [F.count_if(F.col(c).isNull()).alias(c) for c in self._columns]
        return df.observe(self._seen, *counts)

    @property
    def value(self) -> dict[str, int]:
        if not self._columns:
            return {}
        try:
            return {c: n for c, n in self._seen.get.items() if n}
        except Py4JJavaError:
            return {}
