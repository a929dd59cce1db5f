"""Merkle manifest of a dataset: subtrees per group, a proof for each row.

Leaves are ranked in their group. The hexadecimal digits of a rank say where a leaf stands
in its tree of sixteen-way nodes, so grouping by all digits but the last makes the nodes of
the next level, each with its children nested in it, and so on: three digits go one after
the other inside blocks of 4,096 leaves, on one shuffle by block. Roots of blocks are the
leaves of the next round of blocks, until a group is one block.

On the way down a block's nested structs hold all siblings of its leaves: ``transform``
turns them into paths and ``explode`` makes them rows. What a block needs to know of the tree
above it comes as one more row of the block's group, so there is no join on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.ranking import ranked
from lakemart.plans.lineage import cut_lineage

#: Bits of a digit, and digits that are grouped away inside a block.
BITS = 4
DIGITS = 3
_WIDTH = 1 << BITS


def framed(*values: Column) -> Column:
    """Values as one text: each with its UTF-8 length before it, NULL as a dash."""
    fields = []
    for value in values:
        value = value.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(sized, F.lit("-")))
    return F.concat(*fields)


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree with ``size`` leaves."""
    out = F.when(size <= 1, 0)
    for level in range(1, 64 // BITS):
        out = out.when(size <= 1 << BITS * level, level)
    return out.otherwise(64 // BITS)


def _blocks(nodes: DataFrame) -> DataFrame:
    """(grp, block, height, hash, nest): the nodes of each block, nested by their digits.

    ``nodes`` are (grp, rank, height, hash, item); ``height`` counts the levels that the tree
    still has above them. Levels beyond it have one node and don't hash it again.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    out = nodes.select(
        "grp",
        F.shiftright("rank", BITS * DIGITS).alias("block"),
        "height",
        *(F.shiftright("rank", BITS * k).bitwiseAND(_WIDTH - 1).cast("int").alias(d) for k, d in enumerate(digits)),
        "hash",
        F.col("item").alias("kids"),
    ).repartition("grp", "block")
    for level, digit in enumerate(digits, 1):
        kids = F.sort_array(F.collect_list(F.struct(digit, "hash", "kids")))
        out = out.groupBy("grp", "block", "height", *digits[level:]).agg(kids.alias("kids"))
        own = F.when(F.col("height") >= level, digest(_joined(F.col("kids.hash"))))
        out = out.withColumn("hash", own.otherwise(F.col("kids")[0]["hash"]))
    return out.withColumnRenamed("kids", "nest")


def _tree(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Tables of blocks from the leaves up; the last one has one block per group."""
    levels = [cut_lineage(_blocks(nodes), "manifest")]
    while largest > 1 << BITS * DIGITS * len(levels):
        below = levels[-1]
        upper = below.select(
            "grp",
            F.col("block").alias("rank"),
            F.greatest(F.col("height") - DIGITS, F.lit(0)).alias("height"),
            "hash",
            F.col("block").alias("item"),
        )
        levels.append(cut_lineage(_blocks(upper), "manifest"))
    return levels


def _beside(hashes: Column, at: Column) -> Column:
    """What stands left and right of a child among the hashes of its node."""
    return F.struct(
        _joined(F.slice(hashes, F.lit(1), at)).alias("left"),
        _joined(F.slice(hashes, at + 2, F.lit(_WIDTH))).alias("right"),
    )


def _unnested(nest: Column) -> Column:
    """(hash, item, path) of all leaves of a block; DIGITS nested arrays."""

    def within(kids: Column, above: list[Column], depth: int) -> Column:
        def one(kid: Column, at: Column) -> Column:
            path = [_beside(kids["hash"], at), *above]
            if depth == 1:
                return F.struct(kid["hash"].alias("hash"), kid["kids"].alias("item"), F.array(*path).alias("path"))
            return within(kid["kids"], path, depth - 1)

        found = F.transform(kids, one)
        return found if depth == 1 else F.flatten(found)

    return within(nest, [], DIGITS)


def _down(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(grp, item, hash, above) of the leaves; ``tops`` are (grp, above) of each group's root.

    ``above`` is (subroot, root, path) with the path from a node to the root.
    """
    upper = tops.select("grp", F.lit(0).cast("long").alias("block"), "above")
    for level in reversed(levels):
        kind = level.schema["nest"].dataType
        both = level.select("grp", "block", "height", "nest", F.lit(None).cast(upper.schema["above"].dataType).alias("above"))
        both = both.unionAll(
            upper.select("grp", "block", F.lit(None).cast("int").alias("height"), F.lit(None).cast(kind).alias("nest"), "above")
        )
        met = both.groupBy("grp", "block").agg(
            F.max("height").alias("height"),
            F.collect_list("nest")[0].alias("nest"),
            F.collect_list("above")[0].alias("above"),
        )
        rows = met.select("grp", "height", "above", F.explode(_unnested(F.col("nest"))).alias("leaf"))
        own = F.slice("leaf.path", F.lit(1), F.least("height", F.lit(DIGITS)))
        above = F.struct("above.subroot", "above.root", F.concat(own, F.col("above.path")).alias("path"))
        rows = rows.select("grp", F.col("leaf.item").alias("item"), F.col("leaf.hash").alias("hash"), above.alias("above"))
        if level is not levels[0]:
            upper = rows.select("grp", F.col("item").alias("block"), "above")
    return rows


def _nodes(rows: DataFrame, groups: list[str], order: list[Column]) -> tuple[DataFrame, int]:
    placed = ranked(rows, groups, order).withColumn("height", _height(F.col("size")))
    largest = placed.agg(F.max("size")).first()[0] or 0
    return placed.select("grp", "rank", "height", "hash", "item"), largest


def manifest(
    rows: DataFrame, group: str, order: str, columns: list[str], carry: dict[str, Column] | None = None
) -> DataFrame:
    """(group, order, *carry, leaf, subroot, root, path), one row per row of ``rows``.

    A leaf is the digest of ``columns`` as ``framed``. Leaves of a group ascend by ``order``
    (NULL first, ties by leaf) and make its subtree; a single leaf is its subroot. Subroots
    ascend by group (NULL first, bytewise) and make the root. ``path`` has what stands left
    and right of the node on each level from the leaf up. Repeated rows are leaves of their
    own. Other columns are not read. An empty table gives no rows.
    """
    item = F.struct(F.col(order).alias("order"), *(value.alias(name) for name, value in (carry or {}).items()))
    leaves = rows.select(
        F.col(group).alias("grp"),
        digest(framed(*(F.col(name) for name in columns))).alias("hash"),
        item.alias("item"),
        # Tells repeated rows apart, so that very many of them are not one range.
        F.monotonically_increasing_id().alias("uid"),
    )
    leaves = cut_lineage(leaves, "leaves")
    by = [F.col("item.order").asc_nulls_first(), F.col("hash").asc(), F.col("uid").asc()]
    tree = _tree(*_nodes(leaves, ["grp"], by))

    subroots = tree[-1].select(F.lit(0).alias("grp"), "hash", F.col("grp").alias("item"))
    top = _tree(*_nodes(subroots, ["grp"], [F.col("item").asc_nulls_first()]))
    nothing = F.array().cast("array<struct<left: string, right: string>>")
    root = top[-1].select(
        "grp",
        F.struct(F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"), nothing.alias("path")).alias("above"),
    )
    groups = _down(top, root).select(
        F.col("item").alias("grp"),
        F.struct(F.col("hash").alias("subroot"), "above.root", "above.path").alias("above"),
    )
    return _down(tree, groups).select(
        F.col("grp").alias(group),
        F.col("item.order").alias(order),
        *(F.col(f"item.{name}").alias(name) for name in carry or {}),
        F.col("hash").alias("leaf"),
        "above.subroot",
        "above.root",
        "above.path",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda own, at: digest(F.concat(at["left"], own, at["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, as one text."""
    return _joined(F.transform(path, lambda at: F.concat(at["left"], at["right"])))
