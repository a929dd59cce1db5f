"""SimHash near-duplicates: fingerprints, exact search within a radius, components.

Two fingerprints at most r bits apart agree on at least b - r of b blocks of bits.
Every distinct fingerprint goes to one shard per choice of b - r blocks, by its bits
there; b grows with the number of fingerprints, so that shards stay small. A BK-tree
is built over each shard and searched for each of its members. A tree travels to the
task that holds the members that can match it and to no other: all trees together
grow with the corpus, so none is broadcast. Shards that are large all the same
are divided once more by the bits that their members don't share yet.

Each shard returns links that connect what its matches connect, fewer than it has
members, so a large group of near copies never becomes all its pairs.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.bk_forest import Forest, spanning_links
from lakemart.llm.components import smallest_reachable
from lakemart.llm.text_segments import release, text_batches
from lakemart.plans.lineage import cut_lineage

#: Members that a shard has on average, at most, and those beyond which it is divided.
SHARD_MEAN = 256
SHARD_LIMIT = 2048
#: Fingerprints of whole shards that a task works on at once.
CHUNK = 50_000
#: Shingles whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: bytes, size: int = 4, seed: int = 42) -> int:
    """Majority of each bit over the hashes of all word shingles; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist())]
    n = len(shingles)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, STEP):
        octets = hashes[start : start + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash(text: Column, size: int = 4, seed: int = 42) -> Column:
    """Fingerprint of a text as a long (its 64 bits); that of NULL is that of an empty text."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        release()
        found = [fingerprint((value.as_py() or "").encode(), size, seed) for value in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return prints(text)


def _bits(positions) -> int:
    return sum(1 << p for p in positions)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _divided(positions: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, part)) for part in np.array_split(positions, parts)]


def shard_masks(count: int, radius: int) -> list[int]:
    """Masks such that two fingerprints within the radius agree under at least one."""
    blocks = radius + 1
    while blocks < 2 * radius + 1 and count >> (64 * (blocks - radius) // blocks) > SHARD_MEAN:
        blocks += 1
    cut = _divided(list(range(64)), blocks)
    return [_bits(sum(chosen, [])) for chosen in combinations(cut, blocks - radius)]


def _finer_masks(mask: int, radius: int) -> list[int]:
    left = [p for p in range(64) if not mask >> p & 1]
    return [mask | _bits(part) for part in _divided(left, radius + 1)]


def _shards(prints: DataFrame, radius: int) -> DataFrame:
    """(mask, bits, fp): the fingerprints of each shard."""
    masks = shard_masks(prints.count(), radius)

    def keyed(rows: DataFrame, choice: Column) -> DataFrame:
        rows = rows.select("fp", F.explode(choice).alias("mask"))
        return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp")

    coarse = keyed(prints, F.array(*(F.lit(_signed(m)).cast("long") for m in masks)))
    large = coarse.groupBy("mask", "bits").count().where(F.col("count") > SHARD_LIMIT)
    large = large.select("mask", "bits")
    finer = F.create_map(
        *(
            F.lit(value).cast("long") if isinstance(value, int) else value
            for m in masks
            for value in (
                _signed(m),
                F.array(*(F.lit(_signed(x)).cast("long") for x in _finer_masks(m, radius))),
            )
        )
    )
    small = coarse.join(large, ["mask", "bits"], "left_anti")
    divided = keyed(coarse.join(large, ["mask", "bits"], "left_semi"), finer[F.col("mask")])
    return small.unionAll(divided)


def _tree_links(radius: int):
    def links_of(shard: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        forest = Forest(prints.view(np.uint64), shard)
        rows, others = spanning_links(len(prints), forest.pairs_within(radius))
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[rows]), pa.array(prints[others])], names=["a", "b"]
        )

    def links(batches):
        release()
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(3)]))
            size += batch.num_rows
            if size < CHUNK:
                continue
            # The last shard may go on in the next batch.
            rows = np.concatenate(held, axis=1)
            same = (rows[:2] == rows[:2, -1:]).all(axis=0)
            whole = size - int(same.sum())
            held, size = [rows[:, whole:]], size - whole
            if whole:
                yield links_of(_numbered(rows[:2, :whole]), rows[2, :whole])
        if size:
            rows = np.concatenate(held, axis=1)
            yield links_of(_numbered(rows[:2]), rows[2])

    return links


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))]


def near_links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links that connect all distinct ``fp`` that chains of matches connect."""
    shards = _shards(prints, radius).repartition("mask", "bits")
    shards = shards.sortWithinPartitions("mask", "bits", "fp")
    return shards.mapInArrow(_tree_links(radius), "a long, b long")


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over fingerprints at most ``radius``
    bits apart. A NULL doc_id is linked by its text as any other but never names a
    component with another member; NULL and empty texts have the fingerprint 0.
    Repeated rows are members of one component. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    prints = cut_lineage(
        docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp")), "simhash"
    )
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    links = near_links(distinct.select("fp"), radius)
    roots = smallest_reachable(links, "a", "b", "fp", "root")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(named.join(first, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )
