"""Approximate nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more component that makes them equally long, so that the largest
inner product is the smallest distance. They are kept in the inverted list of their
nearest centroid and rotated by a random orthogonal matrix, after which any first d
components are a sample of all. Within a probed list the components are read in
blocks; after each block the distance so far, carried on to all components, is tested
against the query's bound, and candidates that are farther with high confidence are
abandoned. The bound is the k-th best distance within the fitting sample, so the true
neighbours are never beyond it. What is left is scored exactly on the original vectors,
and so are the sample's own best, so that no query has fewer than k answers.

Rows are dealt into blocks by the hash of their id; each block has its part of all lists
and meets each query once. A large table has its first blocks searched first: a whole
distance in the other blocks must not exceed the k-th best that these have given, so the
answers of a query grow with the square root of the blocks.

Centroids are fitted on a bounded sample; all rows are indexed.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.meeting import CHUNK, Rows, groups, stream, usual_width, valid_vectors
from lakemart.plans.lineage import cut_lineage

#: Rows (by the hash of their id) that centroids and bounds are fitted on.
SAMPLE = 4096
#: Inverted lists, and those that a query probes. Near isotropic vectors need most of them:
#: 48 of 64 have found 0.97 of the true neighbours; clustered ones do with fewer.
LISTS = 64
PROBES = 48
#: Components of a block, and standard errors at which a candidate is abandoned.
BLOCK = 16
CONFIDENCE = 2.1
ROUNDS = 8
#: A block has as many vectors as there are queries, so that copies of queries in all
#: blocks are about as many as vectors, but from ``HELD`` to ``MOST``. Smaller tables are
#: dealt into ``SPREAD`` blocks, if these get ``LEAST`` vectors.
HELD = 1 << 14
MOST = 1 << 16
SPREAD = 8
LEAST = 1024
#: Queries that stream past a block in one task, until there are ``TASKS`` tasks.
ASKED = 1 << 16
TASKS = 256
#: Rows of a list that are scanned at once, and pairs that are scored and kept at once.
TILE = 1024
PAIRS = 1 << 16

_NAMES = ("id", "vector", "ids", "bound", "last")


class Space:
    """What was fitted: small arrays that go to every task."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, longest: float, lists: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.ids, self.original = ids, sample
        self.longest = longest
        self.width = sample.shape[1] + 1
        self.turn = np.linalg.qr(random.standard_normal((self.width, self.width)))[0]
        self.sample = self.indexed(sample)
        self.centroids = self._fit(min(lists, len(sample)), random)

    def indexed(self, vectors: np.ndarray) -> np.ndarray:
        rest = self.longest**2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.c_[vectors, np.sqrt(np.maximum(rest, 0))] @ self.turn

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        return np.c_[vectors, np.zeros(len(vectors))] @ self.turn

    def _fit(self, lists: int, random: np.random.Generator) -> np.ndarray:
        centroids = self.sample[random.choice(len(self.sample), lists, replace=False)]
        for _ in range(ROUNDS):
            nearest = distances(self.sample, centroids).argmin(axis=1)
            sums = np.zeros_like(centroids)
            np.add.at(sums, nearest, self.sample)
            sizes = np.bincount(nearest, minlength=lists)
            centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        return centroids

    def bounds(self, asked: np.ndarray, k: int) -> np.ndarray:
        """Squared distance that the k nearest of all rows don't exceed."""
        if len(self.sample) < k:
            return np.full(len(asked), np.inf)
        square = distances(asked, self.sample)
        return widened(np.partition(square, k - 1, axis=1)[:, k - 1])

    def nearest(self, moved: np.ndarray, probes: int) -> np.ndarray:
        """The nearest lists of each row."""
        return np.argsort(distances(moved, self.centroids), axis=1, kind="stable")[:, :probes]


def widened(square):
    """With a margin for rounding; a number, an array or a column."""
    return square * (1 + 1e-9) + 1e-9


def _scored(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> pa.RecordBatch:
    kept = best(query, row, score, k)
    columns = [pa.array(query[kept]), pa.array(row[kept]), pa.array(score[kept])]
    return pa.RecordBatch.from_arrays(columns, names=["query", "vec_id", "score"])


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)
    return np.maximum(square - 2 * left @ right.T, 0)


def scan(
    asked: np.ndarray, rows: np.ndarray, bound: np.ndarray, last: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that no test has abandoned; ``last`` is the bound of whole distances, if another."""
    width = rows.shape[1]
    so_far = np.zeros((len(asked), len(rows)))
    part = np.empty_like(so_far)
    alive = np.ones(so_far.shape, bool)
    for start in range(0, width, BLOCK):
        end = min(start + BLOCK, width)
        left, right = asked[:, start:end], rows[:, start:end]
        if 5 * np.count_nonzero(alive) > alive.size:
            # The expanded square as one product.
            square = np.einsum("ij,ij->i", left, left), np.einsum("ij,ij->i", right, right)
            left = np.c_[-2 * left, square[0], np.ones(len(left))]
            so_far += np.matmul(left, np.c_[right, np.ones(len(right)), square[1]].T, out=part)
        else:
            ask, hit = np.nonzero(alive)
            gap = left[ask] - right[hit]
            so_far[ask, hit] += np.einsum("ij,ij->i", gap, gap)
        if end < width:
            limit = bound * ((1 + CONFIDENCE / np.sqrt(end)) ** 2 * end / width)
        else:
            limit = bound if last is None else last
        alive &= so_far <= limit[:, None]
    return np.nonzero(alive)


def best(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query, ties to the smaller row."""
    order = np.lexsort((row, -score, query))
    ordered = query[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else []
    rank = np.arange(len(ordered)) - np.repeat(first, np.diff(np.r_[first, len(ordered)]).astype(int))
    return order[rank < k]


class _Block:
    """Vectors in the order of their lists, each with its ids."""

    def __init__(self, space: Space, rows: Rows):
        turned = space.indexed(rows.vector)
        home = space.nearest(turned, 1)[:, 0]
        order = np.argsort(home, kind="stable")
        self.vector, self.turned = rows.vector[order], turned[order]
        ids = rows.ids.take(pa.array(order))
        self.ids, self.copies = ids.flatten().to_numpy(), ids.value_lengths().to_numpy()
        self.first = np.cumsum(self.copies) - self.copies
        self.repeated = len(np.unique(self.ids)) < len(self.ids)
        edges = np.searchsorted(home[order], np.arange(len(space.centroids) + 1)).tolist()
        self.pieces = [
            (number, at, min(at + TILE, end))
            for number, (start, end) in enumerate(zip(edges, edges[1:]))
            for at in range(start, end, TILE)
        ]


class _Found:
    """The k best rows of some queries so far."""

    def __init__(self, queries: Rows, block: _Block, k: int):
        self.queries, self.block, self.k = queries, block, k
        self.ask, self.row, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.fresh, self.waiting = [], 0

    def add(self, ask: np.ndarray, hit: np.ndarray) -> None:
        self.fresh.append((ask, hit))
        self.waiting += len(ask)
        if self.waiting >= PAIRS:
            self.settle()

    def settle(self) -> None:
        for ask, hit in self.fresh:
            for at in range(0, len(ask), PAIRS):
                self._take(ask[at : at + PAIRS], hit[at : at + PAIRS])
        self.fresh, self.waiting = [], 0
        kept = self._once()
        kept = kept[best(self.ask[kept], self.row[kept], self.score[kept], self.k)]
        self.ask, self.row, self.score = self.ask[kept], self.row[kept], self.score[kept]

    def _take(self, ask: np.ndarray, hit: np.ndarray) -> None:
        score = np.einsum("ij,ij->i", self.queries.vector[ask], self.block.vector[hit])
        copies = self.block.copies[hit]
        inner = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        row = self.block.ids[np.repeat(self.block.first[hit], copies) + inner]
        self.ask, self.row = np.r_[self.ask, np.repeat(ask, copies)], np.r_[self.row, row]
        self.score = np.r_[self.score, np.repeat(score, copies)]

    def _once(self) -> np.ndarray:
        """Places of the best vector of each id."""
        if not self.block.repeated:
            return np.arange(len(self.ask))
        order = np.lexsort((-self.score, self.row, self.ask))
        ask, row = self.ask[order], self.row[order]
        return order[np.r_[True, (ask[1:] != ask[:-1]) | (row[1:] != row[:-1])][: len(order)]]

    def batch(self) -> pa.RecordBatch:
        self.settle()
        return _scored(self.queries.id[self.ask], self.row, self.score, self.k)


def _worker(space: Space, k: int, probes: int):
    def work(batches):
        block = None
        for fresh, rows, queries in groups(batches):
            if rows is None:
                return
            if fresh:
                block = _Block(space, rows)
            asked = space.asked(queries.vector)
            probed = np.zeros((len(queries), len(space.centroids)), bool)
            np.put_along_axis(probed, space.nearest(asked, probes), True, axis=1)
            found = _Found(queries, block, k)
            for number, start, end in block.pieces:
                some = np.flatnonzero(probed[:, number])
                ask, hit = scan(asked[some], block.turned[start:end], queries.bound[some], queries.last[some])
                found.add(some[ask], hit + start)
            yield found.batch()

    return work


def _sample_worker(space: Space, k: int):
    """The best rows of the sample itself, whose distances the bounds are."""

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                queries = Rows(batch.slice(start, CHUNK))
                square = distances(space.asked(queries.vector), space.sample)
                ask, hit = np.nonzero(square <= queries.bound[:, None])
                score = np.einsum("ij,ij->i", queries.vector[ask], space.original[hit])
                yield _scored(queries.id[ask], space.ids[hit], score, k)

    return work


def sample_bounds(vector: Column, space: Space, k: int) -> Column:
    @F.arrow_udf("double")
    def bounds(vectors: pa.Array) -> pa.Array:
        n = len(vectors)
        rows = vectors.flatten().to_numpy().reshape(n, space.width - 1)
        pieces = [rows[at : at + CHUNK].astype(np.float64) for at in range(0, n, CHUNK)]
        return pa.array(np.concatenate([np.zeros(0), *(space.bounds(space.asked(x), k) for x in pieces)]))

    return bounds(vector)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    vec_id: str,
    vector: str,
    k: int = 20,
    lists: int = LISTS,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query but itself.

    ``queries`` are rows like ``vectors``. Rows without an id, and vectors that are NULL,
    zero, empty, not finite or of another length than most have take no part; rows that
    repeat both id and vector count once. Equal vectors are indexed once with their k + 1
    smallest ids: no answer can hold more. Equal queries are searched once.
    """

    def usable(rows: DataFrame) -> DataFrame:
        rows = rows.select(
            F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector")
        )
        return valid_vectors(rows.where("id is not null"), "vector")

    rows = usable(vectors)
    width = usual_width(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    chosen = rows.orderBy(F.xxhash64("id", F.lit(7)), "id", "vector").limit(SAMPLE).collect()
    if not chosen:
        return rows.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
            F.lit(0.0).alias("score"),
        )
    sample = np.array([row["vector"] for row in chosen], np.float64)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = rows.agg(F.sqrt(F.max(square)).alias("m")).first()["m"]
    space = Space(np.array([row["id"] for row in chosen]), sample, longest, lists)
    equal = Window.partitionBy("vector").orderBy("id")
    entries = rows.withColumn("copy", F.dense_rank().over(equal)).where(F.col("copy") <= k + 1)
    entries = entries.groupBy("vector").agg(F.min("id").alias("id"), F.collect_set("id").alias("ids"))
    entries = cut_lineage(entries, "entries")
    asking = usable(queries).where(F.size("vector") == width).groupBy("vector")
    asking = asking.agg(F.min("id").alias("id"))
    asking = asking.select("id", "vector", sample_bounds(F.col("vector"), space, k + 1).alias("bound"))
    asking = cut_lineage(asking, "queries")
    schema = "query long, vec_id long, score double"
    count, wanted = entries.count(), asking.count()
    held = min(max(HELD, wanted), MOST)
    blocks = max(ceil(count / held), min(SPREAD, ceil(count / LEAST)))
    parts = max(1, min(ceil(wanted / ASKED), ceil(TASKS / blocks)))
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    dealt = dealt.select("block", "id", "vector", "ids", *(F.lit(0.0).alias(name) for name in _NAMES[3:]))

    def numbers(first: int, end: int) -> Column:
        return F.explode(F.sequence(F.lit(first), F.lit(end - 1)))

    def met(asked: DataFrame, first: int, end: int) -> DataFrame:
        """Each of these blocks with each part of the queries."""
        index = dealt.where((F.col("block") >= first) & (F.col("block") < end))
        index = index.withColumn("part", numbers(0, parts))
        index = index.withColumn("grp", (F.col("block") - first) * parts + F.col("part"))
        asked = asked.withColumn("block", numbers(0, end - first)).withColumn("ids", F.array().cast("array<long>"))
        asked = asked.withColumn("grp", F.col("block") * parts + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)))
        worker = _worker(space, k + 1, probes)
        return cut_lineage(stream(index, asked, _NAMES, (end - first) * parts, worker, schema), "found")

    ahead = blocks if blocks <= SPREAD else isqrt(blocks)
    found = met(asking.withColumn("last", F.col("bound")), 0, ahead)
    if ahead < blocks:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        least = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        least = least.withColumn("place", F.row_number().over(order)).where(F.col("place") == k + 1)
        # The distance that has this score.
        reached = widened(square + F.lit(float(longest)) ** 2 - 2 * F.col("score"))
        asked = asking.join(least, F.col("id") == F.col("query"), "left")
        asked = asked.withColumn("last", F.least("bound", reached))
        found = found.unionAll(met(asked, ahead, blocks))
    # Only queries whose lists hold fewer rows within their bound than they want.
    answered = found.groupBy("query").count().where(F.col("count") > k)
    wanting = asking.join(answered, F.col("id") == F.col("query"), "left_anti")
    known = wanting.select("id", "vector", "bound").mapInArrow(_sample_worker(space, k + 1), schema)
    # Equal but for rounding, so a row that is found both ways counts once.
    found = found.unionAll(known).groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    # Each query row gets the answer of its vector without itself.
    named = usable(queries).join(asking.withColumnRenamed("id", "query"), "vector")
    named = named.select(F.col("id").alias("query_id"), "query").distinct()
    answers = named.join(found, "query").where("query_id <> vec_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("place"))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
