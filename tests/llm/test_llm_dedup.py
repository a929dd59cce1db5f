"""SimHash components, BK-trees and repeated passages against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakemart.llm.bk_forest import Forest, spanning_links
from lakemart.llm.components import smallest_reachable
from lakemart.llm.line_dedup import dedup_lines, removed_spans, units, without
from lakemart.llm.simhash import fingerprint, near_links, shard_masks, simhash_components


def groups_of(pairs, nodes):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def plain_fingerprint(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    pick = random.Random(1)
    words = ["A", "bé", "ÀC", "d\u00a0e", "f", "\u2003", "g.", "Zz"]
    for n in [0, 1, 2, 3, 4, 5, 9, 60]:
        for gap in (" ", "\t\n", "\x0b \x0c\r"):
            text = gap.join(pick.choice(words) for _ in range(n))
            assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_forest_finds_all_pairs():
    pick = np.random.default_rng(2)
    centres = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = np.repeat(centres, 20) ^ (np.uint64(1) << pick.integers(0, 64, 800).astype(np.uint64))
    prints = np.unique(np.r_[prints, prints ^ np.uint64(5)])
    group = np.sort(pick.integers(0, 7, len(prints)))
    want = {
        (i, j)
        for i in range(len(prints))
        for j in range(i + 1, len(prints))
        if group[i] == group[j] and int(prints[i] ^ prints[j]).bit_count() <= 4
    }
    got = [pair for a, b in Forest(prints, group).pairs_within(4) for pair in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got))
    assert {tuple(sorted(pair)) for pair in got} == want
    rows, roots = spanning_links(len(prints), Forest(prints, group).pairs_within(4))
    assert groups_of(zip(rows.tolist(), roots.tolist()), range(len(prints))) == groups_of(
        want, range(len(prints))
    )


@pytest.mark.parametrize("count", [10, 10**7, 10**10])
def test_masks_meet_every_pair(count):
    pick = random.Random(count)
    masks = shard_masks(count, 4)
    for _ in range(3000):
        bits = sum(1 << b for b in pick.sample(range(64), 4))
        assert any(not bits & mask for mask in masks)


def test_links_connect_what_is_near(spark, monkeypatch):
    monkeypatch.setattr("lakemart.llm.simhash.SHARD_LIMIT", 20)
    pick = random.Random(5)
    base = [pick.getrandbits(64) for _ in range(30)]
    prints = {b ^ sum(1 << pick.randrange(64) for _ in range(pick.randint(0, 3))) for b in base * 12}
    # A crowd that shares most of its bits, so that its shards are divided.
    prints |= {pick.getrandbits(14) for _ in range(150)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = [
        (a, b)
        for i, a in enumerate(signed)
        for b in signed[:i]
        if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4
    ]
    links = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = [(row["a"], row["b"]) for row in links.collect()]
    assert groups_of(got, signed) == groups_of(near, signed)


def test_components_of_random_graphs(spark):
    pick = random.Random(7)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)]
    edges += [(1000, n) for n in range(1001, 1200)] + [(n, n + 1) for n in range(2000, 2060)]
    rows = [*edges, (5, 5), (None, 3), (3, None)]
    found = smallest_reachable(spark.createDataFrame(rows, "a long, b long"), "a", "b", "n", "r")
    got = {row["n"]: row["r"] for row in found.collect()}
    nodes = {n for edge in edges for n in edge}
    want = groups_of([e for e in edges], nodes)
    assert got == {n: r for n, r in want.items() if n != r}
    empty = spark.createDataFrame([], "a long, b long")
    assert smallest_reachable(empty, "a", "b", "n", "r").count() == 0


TEXT = " ".join(f"word{i % 37} thing{i % 11}" for i in range(200))
ROWS = [
    (7, TEXT),
    (3, TEXT.replace("word5 ", "other ", 1)),
    (9, TEXT.upper()),
    (9, TEXT.upper()),
    (4, ""),
    (2, None),
    (5, "something else entirely in this one"),
    (None, TEXT),
    (None, "a text without an id of its own"),
    (11, "tiny"),
]


def test_components_of_documents(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("fp", F.lit("old"))
    found = simhash_components(docs).collect()
    assert len(found) == len(ROWS)
    got = {}
    for row in found:
        got.setdefault(row["doc_id"], set()).add(row["component_id"])
    assert got[7] == got[3] == got[9] == {3} and got[4] == got[2] == {2}
    assert got[5] == {5} and got[11] == {11} and got[None] == {3, None}
    empty = docs.where("doc_id < 0")
    assert simhash_components(empty).count() == 0


def prose(seed, n):
    pick = random.Random(seed)
    return [f"{pick.choice('abcdefgh')}{pick.randrange(5000)}" for _ in range(n)]


def test_passages_inside_other_lines_go(spark):
    passage = prose(1, 80)
    before, after = prose(2, 40), prose(3, 40)
    rows = [
        (1, " ".join([*before, *passage])),
        (2, " ".join([*prose(4, 30), *[w.upper() for w in passage], *after]) + "\nown line"),
        (3, " ".join(passage)),
        (4, " ".join(prose(5, 60))),
        (5, None),
        (6, ""),
        (4, " ".join(prose(5, 60))),
        (None, "\n".join([" ".join(passage), " ".join(prose(6, 30))])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit(1))
    found = {(row["doc_id"], row["text"]): row["removed"] for row in dedup_lines(docs).collect()}
    by_id = {key[0]: (key[1], spans) for key, spans in found.items()}
    for doc_id, text in rows:
        kept, spans = by_id[doc_id]
        assert kept == (without(text, [(s["start"], s["end"]) for s in spans]) if text else text)
        gone = sum(len(text[s["start"] : s["end"]].split()) for s in spans)
        if doc_id in (1, 4, 5, 6):
            assert not spans
        else:
            # All but what two cuts are apart at each end.
            assert 50 <= gone <= 80
            rest = {2: "own line", 3: "", None: " ".join(prose(6, 30))}
            assert rest[doc_id] in kept
    assert dedup_lines(docs.where("doc_id < 0")).count() == 0


def test_short_phrases_stay_and_long_texts_pass():
    common = "of the and in this way it was"
    digests = set(units(common)[0].tolist())
    assert removed_spans(f"{common}\nsomething new", digests) == []
    long = " ".join(prose(9, 60000))
    assert removed_spans(long, set()) == []
    twice = " ".join(prose(10, 30))
    spans = removed_spans(f"{twice}\nmiddle\n{twice}", set())
    assert spans == [(len(twice) + 8, 2 * len(twice) + 8)]


def test_units_tile_the_words():
    text = "One two,  THREE\n\n four " + " ".join(prose(8, 300))
    _, spans, sizes = units(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text.split())
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and sizes.sum() == len(text.split())
    assert units("")[1] == [] and units(" \n ")[1] == []
