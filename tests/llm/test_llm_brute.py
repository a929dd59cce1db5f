"""Registered queries over a whole small table against brute force."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_llm_dedup import groups_of, plain_fingerprint
from test_llm_near_text import judged
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm.bpe_codec import read_ranks
from lakemart.llm.queries import QUERIES
from lakemart.llm.queries_quality import TARGETS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    import duckdb

    rows = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet' order by 1").fetchall()
    return dict(rows)


def digest(ids, text):
    joined = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_op2(spark, docs, library):
    got = {row[0]: tuple(row[1:4]) for row in QUERIES["op2_bpe_codec"](spark, FOLDER).collect()}
    assert got == {i: digest(library.encode_ordinary(text or ""), text or "") for i, text in docs.items()}


def test_op3(spark, docs):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in QUERIES["op3_token_counts"](spark, FOLDER).collect():
        text = docs[row["doc_id"]] or ""
        n = len(model.encode(text, add_special_tokens=False))
        assert tuple(row[1:4]) == (len(text.encode()), n, n > 1024)


def vectors():
    import duckdb

    rows = duckdb.sql(f"select vec_id, label, embedding from '{FOLDER}/embeddings.parquet' order by 1")
    found = rows.fetchnumpy()
    return np.array(found["vec_id"]), np.array(found["label"]), np.stack(found["embedding"]).astype(float)


def test_op4(spark):
    ids, _, rows = vectors()
    exact = rows @ rows.T
    np.fill_diagonal(exact, -np.inf)
    want, got = set(), set()
    for q in np.flatnonzero(ids % 20 == 0):
        order = np.lexsort((ids, -exact[q]))[: min(20, len(ids) - 1)]
        want |= {(ids[q], ids[i]) for i in order}
    for row in QUERIES["op4_dimension_scan"](spark, FOLDER).collect():
        got.add((row["query_id"], row["vec_id"]))
        q, v = np.searchsorted(ids, [row["query_id"], row["vec_id"]])
        assert abs(row["score"] - exact[q, v]) < 1e-12
    assert len(got) == len(want) and len(want & got) >= 0.9 * len(want)


def test_op5_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op5_toxic_crf"](spark, folder).join(labels, "doc_id").collect()
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
    held = [row for row in found if row["held_out"]]
    assert np.mean([row["predicted"] == row["toxic"] for row in held]) >= 0.93


def test_op6(spark, docs):
    prints = {i: plain_fingerprint(text or "") for i, text in docs.items()}
    ids = list(docs)
    near = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    root = groups_of(near, ids)
    rows = QUERIES["op6_simhash_bk_trees"](spark, FOLDER).collect()
    assert {tuple(row) for row in rows} == {(i, f"{prints[i]:016x}", root[i]) for i in ids}


EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_parts(text):
    """Words with offsets, and the lines and units of a text as (first word, end) pairs."""
    words, lines = [], []
    at = 0
    for line in text.split("\n"):
        first = len(words)
        for word in line.split():
            at = text.index(word, at)
            words.append((word.lower().strip(EDGES) or word, at, at + len(word)))
            at += len(word)
        if len(words) > first:
            lines.append((first, len(words)))
    codes = [zlib.crc32(word.encode()) for word, _, _ in words]
    ends = {end for _, end in lines}
    for i, code in enumerate(codes):
        if all(code < other for k, other in enumerate(codes[max(0, i - 3) : i + 4], max(0, i - 3)) if k != i):
            ends.add(i + 1)
    ends = sorted(ends)
    return words, lines, list(zip([0, *ends], ends))


def plain_spans(text, lines_before, units_before):
    """What goes from a text: later lines, and in lines later units of 22 words or more together."""
    words, lines, units = plain_parts(text)
    plain = [word for word, _, _ in words]
    gone = [False] * len(words)
    lines_here, units_here = set(), set()
    for a, b in lines:
        line = tuple(plain[a:b])
        if line in lines_before or line in lines_here:
            gone[a:b] = [True] * (b - a)
        lines_here.add(line)
    again = []
    for a, b in units:
        unit = tuple(plain[a:b])
        again.append(unit in units_before or unit in units_here or gone[a])
        units_here.add(unit)
    k = 0
    while k < len(units):
        end = k
        while end < len(units) and again[end]:
            end += 1
        if end > k and units[end - 1][1] - units[k][0] >= 22:
            gone[units[k][0] : units[end - 1][1]] = [True] * (units[end - 1][1] - units[k][0])
        k = max(end, k + 1)
    spans = []
    for (_, start, end), drop, before in zip(words, gone, [False, *gone]):
        if drop and before:
            spans[-1] = (spans[-1][0], end)
        elif drop:
            spans.append((start, end))
    return spans, lines_here, units_here


def plain_without(text, spans):
    """A span goes with the white space after it; what ends the text leaves none before it."""
    for start, end in reversed(spans):
        rest = text[end:].lstrip()
        text = text[:start] + rest if rest else text[:start].rstrip()
    return text


def plain_cut(docs):
    lines, units, kept = set(), set(), {}
    for i, text in sorted(docs.items()):
        spans, own_lines, own_units = plain_spans(text or "", lines, units)
        kept[i] = (plain_without(text, spans), spans)
        lines |= own_lines
        units |= own_units
    return kept


def test_op8(spark, docs):
    rows = QUERIES["op8_line_dedup"](spark, FOLDER).collect()
    got = {row["doc_id"]: (row["text"], [tuple(span) for span in row["removed"]]) for row in rows}
    assert got == plain_cut(docs)


def test_op9_meets_the_targets(spark):
    rows = QUERIES["op9_soft_mixing"](spark, "/root/testdata/sf0.01").collect()
    totals = np.zeros(len(TARGETS))
    for row in rows:
        totals += row["rate"] * row["n_words"] * np.array([row[f"p_{name}"] for name in TARGETS])
    assert np.allclose(totals / totals.sum(), list(TARGETS.values()), atol=1e-4)
    assert all(row["rate"] >= 0 and row["copies"] in (int(row["rate"]), int(row["rate"]) + 1) for row in rows)


def test_op10(spark):
    ids, labels, rows = vectors()
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = (rows @ rows.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    got = {row["vec_id"]: row["n_links"] for row in QUERIES["op10_pivot_permutations"](spark, FOLDER).collect()}
    links = np.array([got[i] for i in ids])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.9 * near.sum()


def test_pipeline(spark, docs, library, tmp_path):
    """Each stage on its own input against a plain version of what it decides."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {0: docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, FOLDER)
        out.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            seen[k + 1] = {row["doc_id"]: row["text"] for row in rows.collect()}
    assert set(seen[1]) <= set(docs) and len(seen[1]) >= 0.8 * len(docs)
    gone, missed = judged(sorted(seen[1].items()), set(seen[2]))
    assert gone and len(missed) <= 0.05 * len(gone)
    assert seen[3] == {i: text for i, (text, _) in plain_cut(seen[2]).items()}
    assert set(seen[4]) <= set(seen[3]) and len(seen[4]) >= 0.8 * len(seen[3])
    got = {row["doc_id"]: tuple(row[1:4]) for row in rows.collect()}
    assert got == {i: digest(library.encode_ordinary(text), text) for i, text in seen[4].items()}
