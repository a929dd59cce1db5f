"""Token counts of whole texts by a tokenizer library, lengths only.

Texts are cut where the tokenizer always starts a new piece, and the library sees
each distinct segment once per worker, in batches of about equal bytes. Only the
counts leave the Python worker.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.llm.text_segments import Memo, held, segments

#: Bytes of text handed to the library at once.
BATCH_BYTES = 1 << 18
#: Distinct segments whose counts a worker keeps.
SEGMENT_LIMIT = 1_000_000
#: Texts of at least this many characters that cannot use the memo are cut in parts.
PART_CHARS = 1 << 16

_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_batches(texts: list[str], limit: int = BATCH_BYTES):
    """Consecutive batches of at most ``limit`` bytes; a longer text is one of its own."""
    batch, size = [], 0
    for text in texts:
        n = len(text.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += n
    if batch:
        yield batch


def safe_parts(text: str, size: int = PART_CHARS) -> list[str]:
    """Parts of ``size`` characters and the rest up to the next safe cut."""
    parts, start = [], 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


class Counter:
    """Counts of one tokenizer file, ``.json`` or ``.model``."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._lengths = lambda texts: list(map(len, model.encode(texts, num_threads=1)))
            self._by_segment, self._atoms = False, ()
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._lengths = lambda texts: list(
                map(len, model.encode_batch_fast(texts, add_special_tokens=False))
            )
            # Only the plain byte-level form is known to start a piece at a lone space.
            split = model.pre_tokenizer
            self._by_segment = (
                isinstance(split, ByteLevel)
                and not split.add_prefix_space
                and split.use_regex
                and model.normalizer is None
            )
            added = model.get_added_tokens_decoder().values()
            self._atoms = tuple(token.content for token in added)
            if any(" " in atom for atom in self._atoms) or any(
                token.lstrip or token.rstrip for token in added
            ):
                self._by_segment = False
        self._memo = Memo(lambda rest: self._count([f" {segment}" for segment in rest]), SEGMENT_LIMIT)

    def _count(self, texts: list[str]) -> list[int]:
        return [n for batch in byte_batches(texts) for n in self._lengths(batch)]

    def count(self, text: str) -> int:
        if not self._by_segment:
            return self._count([text])[0]
        if any(atom in text for atom in self._atoms):
            return sum(self._count(safe_parts(text)))
        first, rest = segments(text)
        return sum(self._memo.of(rest)) + self._count([first])[0]


def _counter(path: str) -> Counter:
    return held(("counter", path), lambda: Counter(path))


def token_count(text: Column, path: str) -> Column:
    """Tokens (long) of a whole text without special tokens added; NULL counts as empty."""

    @F.arrow_udf("long")
    def lengths(texts: pa.Array) -> pa.Array:
        counter = _counter(path)
        return pa.array([counter.count(value.as_py() or "") for value in texts], pa.int64())

    return lengths(text)
