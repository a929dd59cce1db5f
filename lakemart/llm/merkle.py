"""Fixity audit of archive replicas by Merkle trees over ordered record ranges.

Records are ordered by id. The leaf of an id hashes the digests of all its records;
sums of digest words do that without collecting them, so an id with very many records
is aggregated before the shuffle. A node of level k hashes the nodes of level k-1 whose
ids fall into its range of 256^k ids, at most 256 of them, so ranges of two replicas
are the same even where records are missing. Nodes also carry the bytes of their
range: the offset of any record follows on the way down, without a running total over
the archive.

Comparing starts at the roots and goes down only where hashes differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.plans.lineage import cut_lineage

#: Bits of the id that one level resolves; children of a node are at most 2**BITS.
BITS = 8
_WORDS = 4


def record_bytes(columns: list[str]) -> Column:
    """A record as text: each field with its length before it, NULL as a dash."""
    fields = []
    for name in columns:
        value = F.col(name).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(sized, F.lit("-")))
    return F.concat(*fields)


def _leaves(records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    record = record_bytes([key, *columns])
    digest = F.sha2(record, 256)
    rows = records.select(
        # A record without an id stands before all others.
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("node"),
        F.octet_length(record).cast("long").alias("bytes"),
        digest.alias("digest"),
    )
    words = [
        F.sum(F.conv(F.substring("digest", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)"))
        for i in range(_WORDS)
    ]
    grouped = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bytes"),
        *(word.alias(f"w{i}") for i, word in enumerate(words)),
    )
    parts = [F.col(name).cast("string") for name in ("n", *(f"w{i}" for i in range(_WORDS)))]
    return grouped.select("node", "n", "bytes", F.sha2(F.concat_ws(":", *parts), 256).alias("hash"))


def _parents(nodes: DataFrame, parent: Column) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("node", "hash")))
    joined = F.concat_ws(
        "|",
        F.transform(children, lambda c: F.concat_ws("=", c["node"].cast("string"), c["hash"])),
    )
    return nodes.groupBy(parent.alias("node")).agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sha2(joined, 256).alias("hash")
    )


def hash_tree(records: DataFrame, key: str, columns: list[str]) -> list[DataFrame]:
    """Levels (node, n, bytes, hash) from the leaves up to the single root.

    Levels are written once to the shared folder; the rows themselves aren't needed
    again. ``columns`` are all that is read besides ``key``.
    """
    levels = [cut_lineage(_leaves(records, key, columns), "merkle")]
    low, high = levels[0].agg(F.min("node"), F.max("node")).first()
    while low is not None and (high >> BITS * (len(levels) - 1)) - (
        low >> BITS * (len(levels) - 1)
    ) >= 1 << BITS:
        levels.append(cut_lineage(_parents(levels[-1], F.shiftright("node", BITS)), "merkle"))
    return [*levels, _parents(levels[-1], F.lit(0).cast("long"))]


def _lifted(tree: list[DataFrame], height: int) -> list[DataFrame]:
    """The same tree with ``height`` levels, so that those of two replicas correspond."""
    levels = tree[:-1]
    while len(levels) < height - 1:
        levels = [*levels, _parents(levels[-1], F.shiftright("node", BITS))]
    return [*levels, _parents(levels[-1], F.lit(0).cast("long"))]


def compare_trees(expected: list[DataFrame], found: list[DataFrame]) -> DataFrame:
    """(key, status, offset, n_bytes, expected, found) for each damaged id.

    ``status`` is corrupt, missing or extra. ``offset`` and ``n_bytes`` are those of the
    expected archive laid out in order of ids (NULL bytes: an extra id, at the place
    where it was put in). Equal roots give no rows, without reading the levels below.
    """
    height = max(len(expected), len(found))
    expected, found = _lifted(expected, height), _lifted(found, height)
    roots = [[row["hash"] for row in tree[-1].select("hash").collect()] for tree in (expected, found)]
    bad = expected[-1].select(F.lit(0).cast("long").alias("parent"), F.lit(0).cast("long").alias("start"))
    if not roots[0]:
        # Nothing was expected, so all that is found is extra and starts at 0.
        bad = found[-1].select(F.lit(0).cast("long").alias("parent"), F.lit(0).cast("long").alias("start"))
    if roots[0] == roots[1]:
        bad = bad.where(F.lit(False))
    for level in range(height - 2, -1, -1):
        above = F.shiftright("node", BITS) if level < height - 2 else F.lit(0).cast("long")
        sides = [
            tree[level].withColumn("parent", above).join(bad.select("parent"), "parent", "left_semi")
            for tree in (expected, found)
        ]
        left = sides[0].select("node", "parent", "bytes", F.col("hash").alias("expected"))
        right = sides[1].select("node", "parent", F.col("hash").alias("found"))
        both = left.join(right, ["node", "parent"], "full_outer").join(bad, "parent")
        # The children of one node, 256 at most.
        before = Window.partitionBy("parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.col("start") + F.coalesce(F.sum("bytes").over(before), F.lit(0))
        differ = both.withColumn("offset", offset).where("not expected <=> found")
        if level:
            bad = differ.select(F.col("node").alias("parent"), F.col("offset").alias("start"))
            bad = cut_lineage(bad, "merkle")
    status = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
    return differ.select(
        F.when(F.col("node") != -(1 << 63), F.col("node")).alias("key"),
        status.otherwise("corrupt").alias("status"),
        "offset",
        F.col("bytes").alias("n_bytes"),
        "expected",
        "found",
    )


def audit(expected: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return compare_trees(hash_tree(expected, key, columns), hash_tree(found, key, columns))

