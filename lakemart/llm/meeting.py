"""Index rows and query rows of the same list meet in tasks of bounded size.

A list with many rows is divided into blocks, and its queries into blocks too; each
block of queries meets each block of index rows in a group of its own. A hot list so
becomes many groups, each with at most about ``INDEX_BLOCK`` index rows in memory, and
no row is left out. Queries stream past the index rows of their group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEX_BLOCK = 1024
QUERY_BLOCK = 4096
#: Query rows that are worked on at once.
CHUNK = 512

_ROW = "id long, n long, vector array<float>, code array<int>"
_NAMES = ("id", "n", "vector", "code")


class Rows:
    """Columns of some rows as arrays; ``ids``, of any length, stays a list."""

    def __init__(self, batch: pa.RecordBatch):
        for name in set(batch.schema.names) - {"grp", "role", "ids"}:
            column = batch.column(name)
            setattr(self, name, _matrix(column) if pa.types.is_list(column.type) else column.to_numpy())
        self.ids = batch.column("ids") if "ids" in batch.schema.names else None
        self.vector = self.vector.astype(np.float64)

    def __len__(self) -> int:
        return len(self.id)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def valid_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector isn't NULL, empty or zero and holds only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return rows.where(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0))


def usual_width(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors, of equally frequent ones the greatest; 0 without any."""
    widths = rows.groupBy(F.size(vector).alias("width")).count()
    found = widths.orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else 0


def meet(
    index: DataFrame,
    queries: DataFrame,
    keys: list[str],
    worker: Callable[[Iterator], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``worker`` over the groups; both tables have ``keys`` and the columns of ``_ROW``."""
    lists = index.groupBy(*keys).agg(F.ceil(F.count("*") / INDEX_BLOCK).alias("blocks"))
    asked = queries.groupBy(*keys).agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("parts"))
    lists = lists.join(asked, keys)
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))
    spread = [
        (index, 0, block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))),
        (queries, 1, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)), part),
    ]
    sides = [
        rows.join(lists, keys).select(*keys, F.lit(role).alias("role"), b.alias("block"), p.alias("part"), *_NAMES)
        for rows, role, b, p in spread
    ]
    group = F.concat_ws(":", *(F.col(key).cast("string") for key in keys), "block", "part")
    rows = sides[0].unionAll(sides[1]).select(group.alias("grp"), "role", *_NAMES)
    rows = rows.repartition("grp").sortWithinPartitions("grp", "role", "id")
    return rows.mapInArrow(worker, schema)


def stream(
    index: DataFrame,
    queries: DataFrame,
    names: tuple[str, ...],
    tasks: int,
    worker: Callable[[Iterator], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``worker`` over groups that were dealt before: both tables have ``grp``, a number below ``tasks``.

    Each group is a task of its own.
    """
    sides = [
        rows.select(F.col("grp").cast("int").alias("grp"), F.lit(role).alias("role"), *names)
        for role, rows in enumerate((index, queries))
    ]
    rows = sides[0].unionAll(sides[1]).repartitionById(tasks, "grp")
    return rows.sortWithinPartitions("grp", "role", "id").mapInArrow(worker, schema)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Rows | None, Rows | None]]:
    """(new, index rows, some queries) in the order of groups; at last (True, None, None)."""
    current, held, index, fresh = None, [], None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        grp = batch.column("grp").to_numpy(zero_copy_only=False)
        role = batch.column("role").to_numpy()
        cuts = np.flatnonzero((grp[1:] != grp[:-1]) | (role[1:] != role[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if grp[start] != current:
                current, held, index = grp[start], [], None
            piece = batch.slice(start, end - start)
            if role[start] == 0:
                held.append(piece)
                continue
            if index is None:
                if not held:
                    continue
                index = Rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, fresh = [], True
            for at in range(0, piece.num_rows, CHUNK):
                yield fresh, index, Rows(piece.slice(at, CHUNK))
                fresh = False
    yield True, None, None
