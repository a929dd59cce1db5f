"""Cuts of a text at which byte-level BPE tokenizers always start a new piece.

The pattern of these tokenizers lets white space join a word only as one leading
space. A single space between two characters that are not white space therefore
opens a piece whatever stands around it, so a text can be cut before each of them
and its parts be encoded alone and repeated parts be looked up.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of whole texts that go to a Python worker at once; Spark's own default is for
#: short rows, and a worker holds its batch several times.
TEXT_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPARKS_DEFAULT = "10000"

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPACE_AND_MORE = re.compile(r" \s")


def segments(text: str) -> tuple[str, list[str]]:
    """First segment, and the others without the space that each of them begins with."""
    if text.endswith(" ") or _SPACE_AND_MORE.search(text):
        parts = _LONE_SPACE.split(text)
    else:
        # Each plain space is followed by another character, and a piece begins with
        # it even if it is the last of a run of white space.
        parts = text.split(" ")
    return parts[0], parts[1:]


_HELD: list = []


def held(key, make: Callable):
    """The object of this worker process for ``key``; only the last one is kept.

    Worker processes outlive stages, and objects with a memo are large: one of an
    earlier stage must not stay beside that of the present one. ``key`` is compared by
    equality and kept alive.
    """
    if not _HELD or _HELD[0] != key:
        _HELD.clear()
        _HELD.extend((key, make()))
    return _HELD[1]


def release() -> None:
    """Drop the object kept for an earlier stage; for work that needs the memory itself."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def text_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches small enough for whole texts, unless it has its own size."""
    if spark.conf.get(_ROWS, _SPARKS_DEFAULT) == _SPARKS_DEFAULT:
        spark.conf.set(_ROWS, str(TEXT_ROWS))


class Memo:
    """Values by key, computed in batches when missing, at most ``limit`` of them kept.

    Kept in two generations: when the young one holds half the limit it becomes the
    old one, and what is used again comes back from there. What was dropped is
    computed again, so the limit bounds the memory of a worker and nothing else.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int):
        self._compute, self._half = compute, limit // 2
        self._young: dict = {}
        self._old: dict = {}

    def of(self, keys: list[str]) -> list:
        try:
            return list(map(self._young.__getitem__, keys))
        except KeyError:
            pass
        values = []
        # In steps, so that one long text cannot exceed the limit either.
        for start in range(0, len(keys), self._half):
            step = keys[start : start + self._half]
            absent = {key for key in step if key not in self._young}
            if len(self._young) + len(absent) > self._half:
                self._old, self._young, absent = self._young, {}, set(step)
            fresh = []
            for key in absent:
                value = self._old.get(key)
                if value is None:
                    fresh.append(key)
                else:
                    self._young[key] = value
            self._young.update(zip(fresh, self._compute(fresh)))
            values += map(self._young.__getitem__, step)
        return values
