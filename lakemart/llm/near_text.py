"""Near copies of texts: SimHash prints, BK-trees over shards, exact Jaccard similarity.

Texts with the same set of word shingles are one node. A node has a print of six 64-bit
words, each bit the majority over the hashes of its shingles under that word's own mixing. Two
sets of similarity 0.8 differ in about 15 of 100 bits, unrelated ones in half of them. Bits of
four words choose shards: each of several tables puts a node by some of these bits, more bits
and more tables as the corpus grows, so that shards stay small and nodes of the least
similarity still meet in one of them in all but 1 of 100 cases. A BK-tree over the first word
of each shard finds the nodes within a radius, the second word confirms them.

What is found only says which nodes may be near copies: they form clusters, and inside a
cluster the sets themselves are compared, so no link rests on an estimate. A set moves to the
task of its cluster, not once for each pair.

A shard or a cluster that is too large for one task is dealt into parts, linked inside each
part, and then only what is not yet linked to the largest group meets all parts, so a group of
very many copies costs as many rows as it has members, and no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.bk_forest import Forest, spanning_links
from lakemart.llm.columns import hashable, named, unused
from lakemart.llm.components import smallest_reachable
from lakemart.llm.text_segments import release, text_batches
from lakemart.plans.lineage import cut_lineage, new_path

#: Words of a shingle, and the least similarity of near copies as a fraction.
SHINGLE = 5
LEAST = (4, 5)
#: Words of a print; the first two are compared, the others choose shards.
WORDS = 6
COMPARED = 2
#: Share of differing bits at the least similarity, and of pairs there that no table may bring together.
DIFFERING = math.acos(2 * 0.8 / 1.8) / math.pi
MISSED = 0.01
#: Differing bits of the first word, and of both that are compared, that near copies may have.
RADIUS = 17
CONFIRMED = 31
#: Members that a shard has on average, and those of a part of a larger one.
SHARD_MEAN = 512
SHARD_PART = 1024
#: One node in so many is counted to find the large shards.
COUNTED = 8
#: Comparisons of shingles that a part of a cluster costs at most, about.
PART_COST = 2e8
#: Rows of whole groups that a task works on at once, and shingles that are mixed at once.
CHUNK = 50_000
STEP = 4096

_MIX = np.random.default_rng(7).integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text of fewer words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < size:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist())]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, shingles, repeat(1)), np.uint64, len(shingles))
    return np.unique(hashes)


def node_of(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes())


def print_of(members: np.ndarray) -> np.ndarray:
    """The words of a set's print."""
    ones = np.zeros(64 * WORDS, np.int64)
    for start in range(0, len(members), STEP):
        mixed = members[start : start + STEP, None] * _MIX
        mixed ^= mixed >> np.uint64(31)
        octets = (mixed * _MIX[::-1]).view(np.uint8).reshape(len(mixed), -1)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(members), bitorder="little").view("<u8")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))


def _nodes(text: Column, what: Callable[[np.ndarray], np.ndarray]) -> Column:
    """(node, found): a text's node with what a function makes of its set."""
    kind = pa.struct([("node", pa.int64()), ("found", pa.list_(pa.int64()))])

    @F.arrow_udf("node long, found array<long>")
    def nodes(texts: pa.Array) -> pa.Array:
        release()
        names, found = [], []
        for value in texts:
            members = shingle_set((value.as_py() or "").encode())
            names.append(node_of(members))
            found.append(what(members))
        node = pa.array(np.array(names, np.uint64).view(np.int64))
        return pa.StructArray.from_arrays([node, _lists(found)], fields=list(kind))

    return nodes(text)


def table_plan(nodes: int) -> tuple[int, int]:
    """Bits that choose a shard, and tables, for so many nodes."""
    bits = max(0, math.ceil(math.log2(max(1, nodes) / SHARD_MEAN)))
    if not bits:
        return 0, 1
    return bits, math.ceil(math.log(MISSED) / math.log(1 - (1 - DIFFERING) ** bits))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _shard_keys(bits: int, tables: int) -> Column:
    """The shards of a node: for each table the hash of its number and the chosen bits."""
    pick = np.random.default_rng(11)
    keys = []
    for table in range(tables):
        chosen = pick.choice(64 * (WORDS - COMPARED), bits, replace=False)
        parts = []
        for word in sorted({int(p) // 64 for p in chosen}):
            mask = sum(1 << int(p) % 64 for p in chosen if int(p) // 64 == word)
            parts.append(F.col("print")[COMPARED + word].bitwiseAND(F.lit(_signed(mask)).cast("long")))
        keys.append(F.xxhash64(F.lit(table), *parts))
    return F.array(*keys)


def _whole_groups(batches, columns: list[str], size_of: Callable[[pa.RecordBatch], int]):
    """Tables of rows with all rows of their groups (grp, part); rows come in that order."""
    held, size = [], 0

    def joined():
        return pa.Table.from_batches(held).combine_chunks()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch.select(["grp", "part", *columns]))
        size += size_of(batch)
        if size < CHUNK:
            continue
        rows = joined()
        grp, part = rows.column("grp").to_numpy(), rows.column("part").to_numpy()
        whole = int(np.flatnonzero((grp != grp[-1]) | (part != part[-1]))[-1]) + 1 if (grp[0], part[0]) != (grp[-1], part[-1]) else 0
        if whole:
            yield rows.slice(0, whole)
            held = rows.slice(whole).combine_chunks().to_batches()
            size = sum(size_of(one) for one in held)
    if held:
        yield joined()


def _group_numbers(rows: pa.Table) -> np.ndarray:
    keys = np.stack([rows.column("grp").to_numpy(), rows.column("part").to_numpy()])
    return np.r_[0, np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))]


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _tree_links(batches):
    """Links that connect the nodes of a shard within the radius."""
    release()
    for rows in _whole_groups(batches, ["node", "w0", "w1"], lambda batch: batch.num_rows):
        groups = _group_numbers(rows)
        node = rows.column("node").to_numpy()
        first, second = (rows.column(c).to_numpy().view(np.uint64) for c in ("w0", "w1"))
        forest = Forest(first, groups)

        def confirmed():
            for left, right in forest.pairs_within(RADIUS):
                apart = np.bitwise_count(first[left] ^ first[right]).astype(np.int64)
                apart += np.bitwise_count(second[left] ^ second[right])
                near = apart <= CONFIRMED
                yield left[near], right[near]

        a, b = spanning_links(len(node), confirmed())
        yield _link_batch(node[a], node[b])


def matches(sets: list[np.ndarray]):
    """Pairs (row, other row) of sets of at least the least similarity."""
    if not sets:
        return
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owners, values = np.repeat(np.arange(len(sets)), sizes)[order], values[order]
    over, under = LEAST
    for q, own in enumerate(sets):
        low = np.searchsorted(values, own)
        count = np.searchsorted(values, own, side="right") - low
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        common = np.bincount(owners[np.repeat(low, count) + at], minlength=len(sets))
        found = np.flatnonzero(common * (over + under) >= over * (sizes + len(own)))
        yield np.full(len(found), q), found


def _set_links(batches):
    """Links that connect the near copies of a part of a cluster."""
    release()
    for rows in _whole_groups(batches, ["node", "members"], lambda batch: 1 + len(batch.column("members").flatten()) // 64):
        groups = _group_numbers(rows)
        node = rows.column("node").to_numpy()
        members = rows.column("members").combine_chunks()
        flat = members.flatten().to_numpy().view(np.uint64)
        sets = np.split(flat, np.cumsum(np.diff(members.offsets.to_numpy()))[:-1])
        for start, end in zip(*(np.r_[0, np.flatnonzero(np.diff(groups)) + 1], np.r_[np.flatnonzero(np.diff(groups)) + 1, len(node)])):
            a, b = spanning_links(end - start, matches(sets[start:end]))
            yield _link_batch(node[start:end][a], node[start:end][b])


def _linked(rows: DataFrame, worker) -> DataFrame:
    """What ``worker`` links inside each (grp, part); a node that is there twice counts once."""
    dealt = rows.repartition("grp", "part").sortWithinPartitions("grp", "part", "node")
    found = dealt.mapInArrow(worker, "a long, b long").where("a <> b")
    return cut_lineage(found, "links")


def _share(parts: str, salt: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(parts).cast("long"))


def _labels(links: DataFrame) -> DataFrame:
    return smallest_reachable(links, "a", "b", "node", "root")


def _joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links; only those that join what is still apart are followed."""
    ends = links
    for side in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
        ends = ends.withColumn(side, F.coalesce(f"{side}_root", side)).drop(f"{side}_root")
    ends = cut_lineage(ends.where("a <> b").distinct(), "links")
    if ends.isEmpty():
        return labels
    more = _labels(ends)
    moved = labels.join(more.select(F.col("node").alias("root"), F.col("root").alias("moved")), "root", "left")
    return cut_lineage(moved.select("node", F.coalesce("moved", "root").alias("root")).unionAll(more), "labels")


def _unlinked_meetings(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(grp, part, ...) rows of groups of several parts, so that each member outside the
    largest linked one meets every other member. ``large`` has (grp, node, parts, ...)."""
    rows = large.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = rows.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("n"))
    whole = linked.groupBy("grp").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("of"))
    whole = whole.where("top.n < of")
    rest = F.greatest(F.lit(1), F.ceil((F.col("of") - F.col("top.n")) * F.col("parts") / F.col("of"))).cast("long")
    rows = rows.join(whole, "grp").withColumn("rest", rest)
    columns = large.columns

    def spread(side: DataFrame, own: Column, other: Column) -> DataFrame:
        return side.withColumns({"x": own, "y": other})

    every = spread(rows, _share("parts", 2), F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)))
    others = rows.where("root <> top.root").withColumn("y", _share("rest", 3))
    others = others.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    both = every.select(*columns, "rest", "x", "y").unionByName(others.select(*columns, "rest", "x", "y"))
    met = both.withColumn("part", F.col("x") * F.col("rest") + F.col("y")).drop("rest", "x", "y", "parts")
    return met.dropDuplicates(["grp", "part", "node"])


def candidate_clusters(nodes: DataFrame) -> DataFrame:
    """(node, root): nodes that chains of near prints connect, the smallest of each left out."""
    bits, tables = table_plan(nodes.count())
    words = [F.col("print")[k].alias(f"w{k}") for k in range(COMPARED)]
    entries = nodes.select(F.explode(_shard_keys(bits, tables)).alias("grp"), "node", *words)
    counted = entries.where(F.pmod(F.xxhash64("node"), F.lit(COUNTED)) == 0).groupBy("grp").count()
    large = counted.where(F.col("count") > SHARD_PART / COUNTED).select(
        F.col("grp").alias("large_grp"), F.ceil(F.col("count") * COUNTED / SHARD_PART).cast("long").alias("parts")
    )
    large = cut_lineage(large, "large")
    if large.isEmpty():
        return _labels(_linked(entries.withColumn("part", F.lit(0).cast("long")), _tree_links))
    sized = entries.join(large, F.col("grp") == F.col("large_grp"), "left").drop("large_grp")
    sized = sized.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    # The salt is the shard's own, so two members that one table parts may meet in another.
    part = F.pmod(F.xxhash64("node", "grp"), F.col("parts"))
    labels = _labels(_linked(sized.withColumn("part", part).drop("parts"), _tree_links))
    return _joined_labels(labels, _linked(_unlinked_meetings(sized.where("parts > 1"), labels), _tree_links))


def _verified(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the near copies among the (node, grp) of clusters."""
    sized = clusters.join(sets.select("node", F.size("members").alias("n")), "node")
    total = sized.groupBy("grp").agg(F.count(F.lit(1)).alias("of"), F.avg("n").alias("mean"))
    room = F.greatest(F.lit(8.0), F.sqrt(PART_COST / F.greatest("mean", F.lit(1.0))))
    parts = total.select("grp", F.ceil(F.col("of") / room).cast("long").alias("parts"))
    placed = cut_lineage(clusters.join(parts, "grp"), "clusters")

    def linked(rows: DataFrame) -> DataFrame:
        return _linked(rows.join(sets, "node").select("grp", "part", "node", "members"), _set_links)

    labels = _labels(linked(placed.withColumn("part", _share("parts", 1))))
    large = placed.where("parts > 1")
    if large.isEmpty():
        return labels
    labels = _joined_labels(labels, linked(large.withColumn("part", _share("parts", 5))))
    return _joined_labels(labels, linked(_unlinked_meetings(large, labels)))


def _row_identity(docs: DataFrame, text: str) -> list[Column]:
    return [F.xxhash64(named(text)), F.xxhash64(F.lit(3), *hashable(docs))]


#: What is known of a row before sets are compared.
ALONE, DOUBTFUL, COMPARED_TEXT = 0, 1, 2


def _doubtful(found: DataFrame, nodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """(key, node, state) of the rows that may go: those of nodes with several rows or in clusters.

    The first row of each node in a cluster is the one whose text is compared.
    """
    named_nodes = nodes.join(clusters.select("node", F.lit(True).alias("near")), "node", "left")
    named_nodes = named_nodes.where("near or copies > 1").select("node", "near", F.col("key").alias("first"))
    state = F.when(F.col("near") & (F.col("key") == F.col("first")), COMPARED_TEXT).otherwise(DOUBTFUL)
    return found.join(named_nodes, "node").select("key", "node", state.alias("state"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies, one row of each component of them.

    The row with the smallest id stays, rows without an id come last; of rows of one id,
    that with the smallest hash of its text. Texts without words (NULL, empty) are copies of
    each other; of equal rows one stays. Columns may have any name, and any type that Parquet
    holds. An empty table gives no rows.

    Texts move once: rows are parted into those that stay for certain and those in doubt, and
    only the latter are looked at again.
    """
    spark = docs.sparkSession
    text_batches(spark)
    same_text, same_row = _row_identity(docs, text)
    key = F.struct(named(doc_id).isNull().alias("nameless"), named(doc_id).alias("id"), same_text.alias("th"), same_row.alias("rh"))
    found = docs.select(key.alias("key"), _nodes(named(text), print_of).alias("found"))
    found = cut_lineage(
        found.select("key", F.col("found.node").alias("node"), F.col("found.found").alias("print")), "prints"
    )
    # Equal sets have equal prints.
    one_print = F.first("print").alias("print")
    nodes = cut_lineage(
        found.groupBy("node").agg(F.min("key").alias("key"), one_print, F.count(F.lit(1)).alias("copies")), "nodes"
    )
    rooted = candidate_clusters(nodes)
    clusters = rooted.select("node", F.col("root").alias("grp"))
    clusters = cut_lineage(clusters.unionAll(clusters.select(F.col("grp").alias("node"), "grp").distinct()), "clusters")

    th, rh, state = (unused(docs, name) for name in ("th", "rh", "state"))
    doubtful = cut_lineage(_doubtful(found, nodes, clusters), "doubtful")
    keys = doubtful.groupBy(F.col("key.th").alias("kt"), F.col("key.rh").alias("kr")).agg(F.max("state").alias("state"))
    keys = cut_lineage(keys, "keys")
    # These keys grow with the corpus, so they are no side to broadcast; texts need no sorting.
    keys = keys.toDF(*(unused(docs, f"key_{name}") for name in keys.columns)).hint("shuffle_hash")
    marked = docs.withColumns({th: same_text, rh: same_row})
    marked = marked.join(keys, (named(th) == keys[0]) & (named(rh) == keys[1]), "left")
    marked = marked.withColumn(state, F.coalesce(keys[2], F.lit(ALONE)))
    marked = marked.select(*map(named, [*docs.columns, th, rh, state]))
    path = new_path(spark, "rows")
    marked.write.partitionBy(state).parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path)

    compared = rows.where(named(state) == COMPARED_TEXT)
    sets = compared.select(_nodes(named(text), lambda members: members).alias("found"))
    sets = sets.select(F.col("found.node").alias("node"), F.col("found.found").alias("members")).dropDuplicates(["node"])
    labels = _verified(clusters, cut_lineage(sets, "sets"))

    named_rows = doubtful.join(labels, "node", "left")
    named_rows = named_rows.select("key", F.coalesce("root", "node").alias("root"))
    counted = cut_lineage(named_rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "rows")
    kept = counted.groupBy("root").agg(F.min("key").alias("kept"))
    stays = counted.join(kept, "root").where(F.col("key") == F.col("kept"))
    stays = stays.select(F.col("key.th").alias("kt"), F.col("key.rh").alias("kr"), "n")
    stays = cut_lineage(stays.groupBy("kt", "kr").agg(F.max("n").alias("n")), "judged")

    def that_stay(condition: str) -> DataFrame:
        side = stays.where(condition).toDF(*(unused(rows, name) for name in stays.columns))
        return rows.where(named(state) != ALONE).join(side, (named(th) == side[0]) & (named(rh) == side[1]), "left_semi")

    result = rows.where(named(state) == ALONE).unionByName(that_stay("n = 1"))
    if not stays.where("n > 1").isEmpty():
        result = result.unionByName(that_stay("n > 1").dropDuplicates([th, rh]))
    return result.select(*map(named, docs.columns))
