"""Repeated lines, and repeated passages inside lines, by hashing lines and units of them.

A whole line that an earlier one repeats goes whatever its length. Passages inside lines
are found by units. A line ends a unit. Inside a line a unit ends after each word whose hash is smaller
than those of its neighbours on both sides, so a passage that stands in the middle
of different lines is cut the same way in all of them. Units are normalised (case,
white space, punctuation at the ends of words) and their digests grouped over the whole
corpus, lines apart from units; the earliest occurrence, by document id and then position,
stays. A later unit goes when it and its neighbours that go too have ``least`` words or more
together, so that phrases that just happen to recur inside lines stay. A passage loses fewer words at each end
than two cuts are apart; all offsets are those of the original text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.columns import hashable, named
from lakemart.llm.text_segments import release, text_batches

#: Words on each side that a cutting word's hash has to be smaller than.
REACH = 3
#: Words of consecutive repeated units inside lines from which on they are removed.
LEAST_WORDS = 22

_WORD = re.compile(r"\S+")
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def _plain(word: str) -> bytes:
    return (word.lower().strip(_EDGES) or word).encode()


def _parsed(text: str) -> tuple[list[bytes], np.ndarray]:
    """The normalised words, and the ends of the lines that have any."""
    # Lines are cut first: a line end is a unit's end whatever the words are.
    lines = [line.split() for line in text.split("\n")]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    return [_plain(word) for line in lines for word in line], np.cumsum(sizes)[sizes > 0]


def _digests(flat: list[bytes], spans: list[tuple[int, int]], seed: int) -> np.ndarray:
    found = (xxhash.xxh3_64_intdigest(b" ".join(flat[a:b]), seed) for a, b in spans)
    return np.fromiter(found, np.uint64, len(spans)).view(np.int64)


def _spans(ends: np.ndarray) -> list[tuple[int, int]]:
    return list(zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()))


def _units(flat: list[bytes], line_ends: np.ndarray):
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64)
    code = np.fromiter(map(zlib.crc32, flat), np.int64, n)
    cut = np.ones(n, bool)
    padded = np.r_[np.full(REACH, 1 << 32), code, np.full(REACH, 1 << 32)]
    for step in range(1, REACH + 1):
        cut &= code < padded[REACH - step : REACH - step + n]
        cut &= code < padded[REACH + step : REACH + step + n]
    cut[line_ends - 1] = True
    ends = np.flatnonzero(cut) + 1
    spans = _spans(ends)
    return _digests(flat, spans, 0), spans, np.diff(np.r_[0, ends])


def units(text: str) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """Digests of the units of a text, their (first word, end) and the words' number."""
    return _units(*_parsed(text))


def _lines(flat: list[bytes], line_ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    spans = _spans(line_ends) if len(line_ends) else []
    return _digests(flat, spans, 1), spans


def lines(text: str) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Digests of the lines of a text that have words, and their (first word, end).

    None is also the digest of a unit: a line repeats only a line.
    """
    return _lines(*_parsed(text))


def _repeats(digests: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    repeats = np.ones(len(digests), bool)
    repeats[np.unique(digests, return_index=True)[1]] = False
    return repeats | np.isin(digests, earlier)


def removed_spans(text: str, earlier: set[int], least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Character offsets (start, end) of the repeated lines and the runs of repeated units.

    ``earlier`` holds the digests of lines and units that an earlier document has; one
    repeats too when it comes a second time in the text itself.
    """
    flat, line_ends = _parsed(text)
    if not flat:
        return []
    before = np.fromiter(earlier, np.int64, len(earlier))
    digests, spans, sizes = _units(flat, line_ends)
    line_digests, line_spans = _lines(flat, line_ends)
    gone = np.zeros(len(flat), bool)
    for at in np.flatnonzero(_repeats(line_digests, before)):
        gone[slice(*line_spans[at])] = True
    # Units of a repeated line repeat with it, wherever its neighbours have cut it.
    repeats = _repeats(digests, before) | gone[[a for a, _ in spans]]
    edges = np.diff(np.r_[0, repeats.astype(np.int8), 0])
    for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
        if sizes[a:b].sum() >= least:
            gone[spans[a][0] : spans[b - 1][1]] = True
    if not gone.any():
        return []
    at = [match.span() for match in _WORD.finditer(text)]
    edges = np.diff(np.r_[0, gone.astype(np.int8), 0])
    runs = zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))
    return [(at[a][0], at[b - 1][1]) for a, b in runs]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; the white space around one shrinks to that before it."""
    if not spans:
        return text
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
        while at < len(text) and text[at].isspace():
            at += 1
    return "".join([*parts, text[at:]]).rstrip() if at >= len(text) else "".join([*parts, text[at:]])


def _first_digests(text: Column) -> Column:
    """The distinct digests of the lines and units of a text."""

    @F.arrow_udf("array<long>")
    def digests(texts: pa.Array) -> pa.Array:
        release()
        parsed = [_parsed(value.as_py() or "") for value in texts]
        found = [np.unique(np.r_[_units(*one)[0], _lines(*one)[0]]) for one in parsed]
        offsets = np.cumsum([0, *map(len, found)])
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))

    return digests(text)


def _cut(text: Column, earlier: Column, least: int) -> Column:
    kept = pa.struct(
        [
            ("text", pa.string()),
            ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    @F.arrow_udf("text string, removed array<struct<start: int, end: int>>")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        release()
        rows = []
        for value, digests in zip(texts, lists):
            whole = value.as_py()
            spans = removed_spans(whole or "", set(digests.as_py() or ()), least)
            kept_text = without(whole, spans) if spans else whole
            rows.append(
                {"text": kept_text, "removed": [{"start": a, "end": b} for a, b in spans]}
            )
        return pa.array(rows, kept)

    return cut(text, earlier)


def _told_apart(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rest, text, id, mark): a row's other columns as one, and ``mark``, a hash of the row.

    ``id`` is NULL for rows without one; ``mark`` orders these. Equal ones are counted, and each
    gets its own.
    """
    keys = hashable(docs)
    rows = docs.select(
        F.struct(*(named(c) for c in docs.columns if c != text)).alias("rest"),
        named(text).alias("text"),
        named(doc_id).alias("own"),
        F.xxhash64(F.lit(1), *keys).alias("k1"),
        F.xxhash64(F.lit(2), *keys).alias("k2"),
    )
    known = rows.where("own is not null").select(
        "rest", "text", F.col("own").cast("long").alias("id"), F.xxhash64(F.lit(0), "own", "text").alias("mark")
    )
    nameless = rows.where("own is null").groupBy("k1", "k2").agg(
        F.any_value("rest").alias("rest"), F.any_value("text").alias("text"), F.count("*").alias("n")
    )
    nameless = nameless.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
        "rest", "text", F.lit(None).cast("long").alias("id"), F.xxhash64(F.lit(1), "k1", "k2", "copy").alias("mark")
    )
    return known.unionByName(nameless)


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST_WORDS,
    removed: str = "removed",
) -> DataFrame:
    """``docs`` with its text cut and ``removed``, the spans of the original text that went.

    Rows of the same doc_id are one document and don't count as repeats of each other.
    Each row without an id is a document of its own; these come after all others, in the
    order of a hash of the row. NULL texts stay NULL, and a text that repeats as a whole
    becomes empty; no row goes. Columns may have any name and type; one that is called like
    ``removed`` is replaced.
    """
    text_batches(docs.sparkSession)
    rows = _told_apart(docs, doc_id, text)
    found = rows.select("id", "mark", F.explode(_first_digests(F.col("text"))).alias("unit"))
    # One exchange serves the grouping and the join with what it found.
    found = found.repartition("unit")
    order = F.when(F.col("id").isNull(), F.col("mark"))
    first = found.groupBy("unit").agg(
        F.min("id").alias("first"),
        F.max("id").alias("last"),
        F.min(order).alias("next"),
        F.max(order).alias("end"),
    )
    known, nameless = F.col("first").isNotNull(), F.col("next").isNotNull()
    repeats = (known & nameless) | F.coalesce(F.col("first") < F.col("last"), F.col("next") < F.col("end"))
    shared = first.where(repeats).select("unit", "first", "next")
    after = F.when(F.col("id").isNull(), known | (F.col("mark") > F.col("next")))
    later = found.join(shared, "unit").where(after.otherwise(F.col("id") > F.col("first")))
    # As many as a text has lines and units; a set, as equal rows of one id share them.
    lists = later.groupBy("mark").agg(F.collect_set("unit").alias("earlier"))
    cut = rows.join(lists, "mark", "left").withColumn("cut", _cut(F.col("text"), F.col("earlier"), least))
    columns = [
        F.col("cut.text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns if c != removed
    ]
    return cut.select(*columns, F.col("cut.removed").alias(removed))
