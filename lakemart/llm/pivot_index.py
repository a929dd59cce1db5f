"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its nearest reference points in order. It is indexed under
the nearest one and looked up under the nearest few. Inverted lists from pivots to the
vectors that name them count the pivots that query and candidate share; those that share
enough are verified by their cosine on the original vectors.

Equal vectors are one entry with a multiplicity. Matches never leave a task as pairs:
it returns the number of links of each vector and links that connect what the
matches connect.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.bk_forest import spanning_links
from lakemart.llm.components import smallest_reachable
from lakemart.llm.meeting import Rows, groups, meet, usual_width, valid_vectors
from lakemart.plans.lineage import cut_lineage

#: Reference points (vectors of the table, by the hash of their id).
PIVOTS = 96
#: Nearest pivots that describe a vector, and those of them under which it is looked up.
PREFIX = 8
PROBES = 4
#: Pivots that a candidate shares with a query at least.
SHARED = 3


def nearest_pivots(vector: Column, pivots: np.ndarray, prefix: int) -> Column:
    units = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        n = len(vectors)
        if not n:
            return pa.array([], pa.list_(pa.int32()))
        rows = vectors.flatten().to_numpy().reshape(n, -1).astype(np.float64)
        order = np.argsort(-(rows @ units.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)
        offsets = np.arange(n + 1, dtype=np.int32) * order.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(order.ravel()))

    return nearest(vector)


class _Index:
    """Inverted lists of one block."""

    def __init__(self, rows: Rows, pivots: int):
        self.rows = rows
        self.length = np.linalg.norm(rows.vector, axis=1)
        order = np.argsort(rows.code.ravel(), kind="stable")
        self.posting = order // rows.code.shape[1]
        self.start = np.searchsorted(rows.code.ravel()[order], np.arange(pivots + 1))
        self.gained = np.zeros(len(rows), np.int64)

    def candidates(self, queries: Rows, shared: int) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(self.rows), len(queries)
        pivot = queries.code.ravel()
        asking = np.repeat(np.arange(size), queries.code.shape[1])
        count = self.start[pivot + 1] - self.start[pivot]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found = self.posting[np.repeat(self.start[pivot], count) + inner]
        shares = np.bincount(np.repeat(asking, count) * n + found, minlength=size * n)
        return np.divmod(np.flatnonzero(shares >= shared), n)


def _worker(pivots: int, probes: int, shared: int, least: float):
    def gains(index: _Index) -> pa.RecordBatch:
        some = np.flatnonzero(index.gained)
        return _batch(index.rows.id[some], index.gained[some], np.zeros(0, np.int64), np.zeros(0, np.int64))

    def work(batches):
        index = None
        for fresh, rows, queries in groups(batches):
            if fresh and index is not None:
                yield gains(index)
            if rows is None:
                return
            if fresh:
                index = _Index(rows, pivots)
            ask, hit = index.candidates(queries, shared)
            other = queries.id[ask] != rows.id[hit]
            ask, hit = ask[other], hit[other]
            length = np.linalg.norm(queries.vector, axis=1)
            product = np.einsum("ij,ij->i", queries.vector[ask], rows.vector[hit])
            near = product >= least * length[ask] * index.length[hit]
            ask, hit = ask[near], hit[near]
            if not len(ask):
                continue
            links = np.bincount(ask, weights=rows.n[hit], minlength=len(queries)).astype(np.int64)
            # Where the other isn't looked up under this one's pivot, it won't find it itself.
            home = queries.code[ask, 0]
            unseen = ~(rows.code[hit, :probes] == home[:, None]).any(axis=1)
            np.add.at(index.gained, hit[unseen], queries.n[ask[unseen]])
            ids, place = np.unique(np.r_[queries.id[ask], rows.id[hit]], return_inverse=True)
            half = len(ask)
            node, root = spanning_links(len(ids), [(place[:half], place[half:])])
            some = np.flatnonzero(links)
            yield _batch(queries.id[some], links[some], ids[node], ids[root])

    return work


def _batch(ids, counts, nodes, roots) -> pa.RecordBatch:
    """Rows (id, n, NULL) with the number of links, and (id, 0, other) with a link."""
    none = pa.nulls(len(ids), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.r_[ids, nodes].astype(np.int64)),
            pa.array(np.r_[counts, np.zeros(len(nodes))].astype(np.int64)),
            pa.concat_arrays([none, pa.array(np.asarray(roots, np.int64))]),
        ],
        names=["id", "n", "other"],
    )


def near_duplicates(
    vectors: DataFrame,
    vec_id: str,
    vector: str,
    label: str,
    least: float = 0.93,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    probes: int = PROBES,
    shared: int = SHARED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Links join vectors with the same label (not NULL) whose cosine in double precision is
    ``least`` or more. NULL, zero, empty or not finite vectors, those of another length than
    most vectors have and rows without an id link with nothing and are their own
    component. Rows that share an id and a vector count as vectors that are linked;
    rows that share only the id are one node of the components.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<float>").alias("vector"),
        F.col(label).alias("label"),
    )
    usable = valid_vectors(rows.where("vec_id is not null and label is not null"), "vector")
    width = usual_width(usable, "vector")
    regular = usable.where(F.size("vector") == width)
    chosen = regular.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id", "vector").limit(pivots).collect()
    points = [np.array(row["vector"], np.float64) for row in chosen]
    prefix = min(prefix, len(points))
    # With fewer pivots than that, copies share all there are.
    shared = min(shared, prefix)
    entries = regular.groupBy("label", "vector")
    entries = entries.agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    if not points:
        empty = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"))
        return _with_kept(empty.withColumn("component_id", F.col("vec_id")))
    described = nearest_pivots(F.col("vector"), np.stack(points), prefix)
    entries = cut_lineage(entries.withColumn("code", described), "pivots")
    columns = ["label", "pivot", "id", "n", "vector", "code"]
    index = entries.withColumn("pivot", F.col("code")[0]).select(*columns)
    asked = entries.withColumn("pivot", F.explode(F.slice("code", 1, probes))).select(*columns)
    work = _worker(len(points), probes, shared, least)
    found = cut_lineage(
        meet(index, asked, ["label", "pivot"], work, "id long, n long, other long"), "links"
    )
    roots = smallest_reachable(found.where("other is not null"), "id", "other", "id", "root")
    counts = found.where("other is null").groupBy("id").agg(F.sum("n").alias("linked"))
    # An entry's own copies link with each other as well.
    entries = entries.join(counts, "id", "left").join(roots, "id", "left").select(
        "label",
        "vector",
        (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
    )
    joined = rows.withColumn("_key", F.when(F.col("vec_id").isNotNull(), F.col("label"))).join(
        entries.withColumnRenamed("label", "_key"), ["_key", "vector"], "left"
    )
    return _with_kept(
        joined.select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
    )


def _with_kept(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
