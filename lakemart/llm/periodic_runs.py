"""Maximal periodic runs of words, by string synchronising sets.

A run is a stretch with smallest period q, at least ``repeats`` times q long, that can't be
extended. For each dyadic scale t, a synchronising set holds the positions i at which the
least hash of the t-word contexts between i and i + t is at one of these two ends, so equal
surroundings of 2t words are chosen alike. Pairs of chosen positions with equal surroundings
4t to 8t words apart propose their distance as a period, and the longest common extensions to
both sides say how far it holds. Between two places one period apart in a run there is always
such a pair, unless all contexts there have a period of t / 3 or less themselves. Those take
no part in the choice: they are the runs found at smaller scales. The smallest periods, under
16, are found by comparing the words with themselves that many places on.

Many texts are one sequence of numbers here, divided by numbers that occur once: no run can
hold one of these, so none crosses the end of a text.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.llm.text_segments import release

#: Least length of a run in words, and in periods.
LEAST = 24
REPEATS = 3
#: Periods below this are compared directly.
DIRECT = 16
#: Words that are worked on at once; a longer text is worked on alone.
WORDS = 1 << 17

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _MIX
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


class _Contexts:
    """Hashes of all stretches whose length is a power of two: ``level[k][i]`` of 2^k words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.level = [_mixed(words.astype(np.uint64) + np.uint64(1))]
        while 2 << len(self.level) <= 2 * longest and len(self.level[-1]) > 1 << len(self.level) - 1:
            half, last = 1 << len(self.level) - 1, self.level[-1]
            self.level.append(_mixed(last[:-half] * np.uint64(3) + last[half:] * np.uint64(5)))

    def common_after(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Words from ``left`` and ``right`` (the larger) on that are the same."""
        found = np.zeros(len(left), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            last = len(self.level[k]) - 1
            a, b = left + found, right + found
            same = b <= last
            same[same] = self.level[k][a[same]] == self.level[k][b[same]]
            found += same.astype(np.int64) << k
        return found

    def common_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Words before ``left`` (the smaller) and ``right`` that are the same."""
        found = np.zeros(len(left), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            a, b = left - found - (1 << k), right - found - (1 << k)
            same = a >= 0
            same[same] = self.level[k][a[same]] == self.level[k][b[same]]
            found += same.astype(np.int64) << k
        return found


def _direct(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretches with that period, ``REPEATS`` times as long or longer."""
    same = np.zeros(len(words) - period + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:]
    edges = np.diff(same)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + period
    long = end - start >= REPEATS * period
    return start[long], end[long]


def _highly_periodic(runs: np.ndarray, size: int, count: int) -> np.ndarray:
    """Whether the context of ``size`` words at each position has a period of a third or less."""
    start, end, period = runs
    covers = (period <= size // 3) & (end - start >= size)
    change = np.zeros(count + 1, np.int32)
    np.add.at(change, start[covers], 1)
    np.add.at(change, end[covers] - size + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _synchronising(hashes: np.ndarray, excluded: np.ndarray, size: int) -> np.ndarray:
    """Positions at which the least hash within ``size`` places is at the first or the last of them."""
    none = np.iinfo(np.uint64).max
    value = np.where(excluded, none, hashes)
    least, width = value, 1
    while width < size:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    n = len(value) - size
    first, last = value[:n], value[size:]
    least = np.minimum(least[:n], last)
    return np.flatnonzero((least != none) & ((least == first) | (least == last)))


def _proposals(chosen: np.ndarray, context: np.ndarray, low: int, high: int):
    """(position, distance) of chosen positions with equal contexts ``low`` to ``high`` places on."""
    order = np.lexsort((chosen, context[chosen]))
    at, key = chosen[order], context[chosen][order]
    step, positions, distances = 1, [], []
    while step < len(at):
        apart = at[step:] - at[:-step]
        same = (key[step:] == key[:-step]) & (apart < high)
        if not same.any():
            break
        hit = same & (apart >= low)
        positions.append(at[:-step][hit])
        distances.append(apart[hit])
        step += 1
    if not positions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(positions), np.concatenate(distances)


def periodic_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows start, end and smallest period of all runs, by start and then period.

    ``words`` are numbers of words, ``longest`` the length of the longest text among them.
    """
    found = [np.zeros((3, 0), np.int64)]
    for period in range(1, min(DIRECT, len(words) // REPEATS + 1)):
        start, end = _direct(words, period)
        found.append(np.stack([start, end, np.full(len(start), period)]))
    # Those too short to be runs still say which contexts of a few words are highly periodic.
    runs = np.concatenate(found, axis=1)
    contexts, scale = None, DIRECT
    while REPEATS * scale <= longest:
        if contexts is None:
            contexts = _Contexts(words, longest)
        size = scale // 4
        k = size.bit_length() - 1
        if k + 1 >= len(contexts.level):
            break
        hashes = contexts.level[k]
        chosen = _synchronising(hashes, _highly_periodic(runs, size, len(hashes)), size)
        chosen = chosen[chosen < len(contexts.level[k + 1])]
        at, period = _proposals(chosen, contexts.level[k + 1], scale, 2 * scale)
        start = at - contexts.common_before(at, at + period)
        end = at + period + contexts.common_after(at, at + period)
        long = end - start >= np.maximum(LEAST, REPEATS * period)
        runs = np.concatenate([runs, np.stack([start, end, period])[:, long]], axis=1)
        scale *= 2
    runs = runs[:, runs[1] - runs[0] >= LEAST]
    # A multiple of the smallest period holds on the same stretch.
    order = np.lexsort((runs[2], runs[1], runs[0]))
    runs = runs[:, order]
    fresh = np.ones(runs.shape[1], bool)
    fresh[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    runs = runs[:, fresh]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one sequence of numbers, each followed by one of its own, and their first places."""
    known: dict[bytes, int] = {}
    flat, starts = [], []
    for k, words in enumerate(texts):
        starts.append(len(flat))
        flat += [known.setdefault(word, len(known)) for word in words]
        flat.append(-1 - k)
    return np.array(flat, np.int64), np.array(starts, np.int64)


_KIND = pa.struct(
    [
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("best", pa.int32()),
        ("collapsed_sha256", pa.string()),
    ]
)


def _best(runs: list[tuple[int, int, int]]) -> int | None:
    """Index of the run with the greatest exponent, then the smallest start and period."""
    order = sorted(range(len(runs)), key=lambda i: (-Fraction(runs[i][1], runs[i][2]), runs[i][0], runs[i][2]))
    return order[0] if order else None


def _described(texts: list[list[bytes]]) -> list[dict]:
    flat, starts = numbered(texts)
    found = periodic_runs(flat, max(map(len, texts), default=0))
    owner = np.searchsorted(starts, found[0], side="right") - 1
    out = [{"runs": [], "kept": None} for _ in texts]
    for k, (start, end, period) in zip(owner.tolist(), found.T.tolist()):
        first = start - int(starts[k])
        out[k]["runs"].append((first, end - start, period))
    rows = []
    for words, one in zip(texts, out):
        runs = one["runs"]
        if runs:
            gone = np.zeros(len(words), bool)
            for start, length, period in runs:
                gone[start + period : start + length] = True
            words = [word for word, drop in zip(words, gone.tolist()) if not drop]
        rows.append(
            {
                "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs],
                "best": _best(runs),
                "collapsed_sha256": hashlib.sha256(b" ".join(words)).hexdigest(),
            }
        )
    return rows


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repetition written into one document of ten, by the CRC-32 of its id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + [period[i % len(period)] for i in range(n - a)]


def runs_of(text: Column, doc_id: Column | None = None) -> Column:
    """(runs, best, collapsed_sha256) of the words of a text.

    Words end at ASCII white space. ``runs`` are (start, length, period) in words by start and
    period, ``best`` is the index of the one with the greatest length / period. A word goes from
    the collapsed text if a run holds it after its first period; the others are joined by one
    space. NULL is an empty text. With ``doc_id``, texts are changed by ``planted`` first.
    """

    def described(texts: pa.Array, ids) -> pa.Array:
        release()
        rows, held, size = [], [], 0
        for value, one in zip(texts, ids):
            words = (value.as_py() or "").encode().split()
            held.append(planted(words, one))
            size += len(words)
            if size >= WORDS:
                rows += _described(held)
                held, size = [], 0
        if held:
            rows += _described(held)
        return pa.array(rows, _KIND)

    kind = "runs array<struct<start: long, length: long, period: long>>, best int, collapsed_sha256 string"
    if doc_id is None:

        @F.arrow_udf(kind)
        def plain(texts: pa.Array) -> pa.Array:
            return described(texts, [None] * len(texts))

        return plain(text)

    @F.arrow_udf(kind)
    def changed(texts: pa.Array, ids: pa.Array) -> pa.Array:
        return described(texts, ids.to_pylist())

    return changed(text, doc_id)
