"""Byte-level BPE encoding and decoding by matches and backtracking.

Bytes are mapped to the Latin-1 characters of the same number, so that the token
table can be searched by an Aho-Corasick automaton over text. Encoding takes the
longest token at each position and steps back to shorter ones where two neighbours
are not compatible. Two tokens are compatible when merging their joined bytes by rank
gives the two again, that is when no merge across their border comes first; a
sequence whose neighbours all are is the one that the merges produce. Compatibility is remembered per pair, and a position that led to
nothing is never tried again, so the work is linear in the length of a piece.
"""

from __future__ import annotations

import base64
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.llm.text_segments import Memo, held, segments

#: Distinct text segments whose ids a worker keeps.
SEGMENT_LIMIT = 400_000
#: Pairs of tokens whose compatibility a worker keeps.
PAIR_LIMIT = 300_000
#: White space as the tokenizer's own pattern library reads it.
_WHITE = r"\t-\r \x85\xa0  -     　"


def compile_pattern(pattern: str) -> regex.Pattern:
    """The split pattern with its white space spelled out (it differs between libraries)."""
    spelled = pattern.replace(r"[^\s", f"[^{_WHITE}")
    spelled = spelled.replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")
    return regex.compile(spelled)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._pieces = compile_pattern(pattern)
        self._rank = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self._token = {rank: token for token, rank in self._rank.items()}
        tokens = {rank: token for token, rank in ranks.items()}
        ordered = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
        self._table = np.frombuffer(b"".join(ordered), np.uint8)
        self._sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._automaton = ahocorasick.Automaton()
        for token, rank in self._rank.items():
            self._automaton.add_word(token, rank)
        self._automaton.make_automaton()
        self._length = [len(self._token.get(rank, "")) for rank in range(max(self._token) + 1)]
        self._shorter: dict[int, int] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        self._memo = Memo(
            lambda rest: self._packed([f" {segment}" for segment in rest]), SEGMENT_LIMIT
        )

    def _merged(self, text: str, least: int = 1) -> list[str]:
        """The merges by rank, plainly, down to ``least`` parts; only for single tokens."""
        parts = list(text)
        while len(parts) > least:
            ranks = [self._rank.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            known = [rank for rank in ranks if rank >= 0]
            if not known:
                break
            at = ranks.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, rank: int, side: int) -> list[tuple[str, int, int]]:
        """What stands at the left (0) or right (1) end of a token while it is merged.

        Each state with the rank that formed it and the rank that took it up; a single
        byte is there from the start and the whole token stays. Empty when the merges
        don't form the token from its bytes.
        """
        spine = self._spines[side].get(rank)
        if spine is None:
            token, taken, spine = self._token[rank], len(self._rank), []
            parts = self._merged(token, 2)
            while len(parts) == 2:
                formed = self._rank.get(token, -1)
                spine.append((token, formed, taken))
                token, taken = parts[side], formed
                parts = self._merged(token, 2)
            if len(token) == 1:
                spine.append((token, -1, taken))
            else:
                spine = []
            self._spines[side][rank] = spine
        return spine

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these neighbours as they are; left -1: start of the piece."""
        fits = self._fits.get((left, right))
        if fits is None:
            if len(self._fits) >= PAIR_LIMIT:
                self._fits.clear()
            fits = self._fits[left, right] = self._unmerged(left, right)
        return fits

    def _unmerged(self, left: int, right: int) -> bool:
        """No merge across the border comes before those that take up its two sides."""
        starts = self._spine(right, 0)
        ends = self._spine(left, 1) if left >= 0 else [("", -1, -1)]
        for end, end_formed, end_taken in ends:
            for start, start_formed, start_taken in starts:
                # Of merges of equal rank the leftmost is first.
                together = end_formed <= start_taken and start_formed < end_taken
                if together and end_taken > (across := self._rank.get(end + start, end_taken)):
                    if across <= start_taken:
                        return False
        return bool(ends and starts)

    def _next_shorter(self, rank: int) -> int:
        """The longest token that is a proper prefix; -1 if none."""
        shorter = self._shorter.get(rank)
        if shorter is None:
            token = self._token[rank]
            found = (self._rank.get(token[:size], -1) for size in range(len(token) - 1, 0, -1))
            shorter = self._shorter[rank] = next((rank for rank in found if rank >= 0), -1)
        return shorter

    def _split_ids(self, piece: str) -> list[int]:
        """Ids of a match of the pattern that is no token, given in Latin-1 characters."""
        # Most often the longest tokens, one after the other, already fit.
        size, at, last, ids = len(piece), 0, -1, []
        length, fits = self._length, self._fits
        for end, rank in self._automaton.iter_long(piece):
            at += length[rank]
            if end + 1 != at or not (fits.get((last, rank)) or self._compatible(last, rank)):
                at = -1
                break
            ids.append(rank)
            last = rank
        if at == size:
            return ids
        token = self._token
        longest = [-1] * (size + 1)
        for end, rank in self._automaton.iter(piece):
            # Matches come by their end, so the last one kept for a start is its longest.
            longest[end + 1 - len(token[rank])] = rank
        dead = bytearray(size + 1)
        ids = []
        at, candidate = 0, longest[0]
        while at < size:
            last = ids[-1] if ids else -1
            while candidate >= 0:
                end = at + len(token[candidate])
                if not dead[end] and self._compatible(last, candidate):
                    break
                candidate = self._next_shorter(candidate)
            if candidate >= 0:
                ids.append(candidate)
                at, candidate = end, longest[end]
            elif ids:
                dead[at] = 1
                back = ids.pop()
                at -= len(token[back])
                candidate = self._next_shorter(back)
            else:
                raise ValueError("the rank table lacks single bytes")
        return ids

    def _packed(self, texts: list[str]) -> list[bytes]:
        """Ids as the bytes of an int32 array: one object for a segment, joined as they are."""
        found = []
        for text in texts:
            ids: list[int] = []
            for piece in self._pieces.findall(text):
                if not piece.isascii():
                    piece = piece.encode().decode("latin-1")
                whole = self._rank.get(piece)
                if whole is None:
                    ids += self._split_ids(piece)
                else:
                    ids.append(whole)
            found.append(array("i", ids).tobytes())
        return found

    def encode(self, text: str) -> np.ndarray:
        first, rest = segments(text)
        packed = [*self._packed([first]), *self._memo.of(rest)]
        return np.frombuffer(b"".join(packed), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        known = (ids >= 0) & (ids < len(self._sizes))
        if not known.all() or not (sizes := self._sizes[ids]).all():
            raise ValueError("ids without a token")
        ends = np.cumsum(sizes, dtype=np.int64)
        if not len(ends):
            return b""
        # Each byte's place in the table: where its token starts, and how far in it is.
        shift = self._starts[ids] - (ends - sizes)
        return self._table[np.repeat(shift, sizes) + np.arange(ends[-1])].tobytes()


def _codec(path: str, pattern: str) -> Codec:
    return held(("codec", path, pattern), lambda: Codec(read_ranks(path), pattern))


class _Grown:
    """Values of different lengths, one after the other in one buffer."""

    def __init__(self):
        self._data, self._ends = bytearray(), array("q", [0])

    def add(self, value: bytes | np.ndarray) -> None:
        self._data += memoryview(value).cast("B") if len(value) else b""
        self._ends.append(len(self._data))

    def lists(self) -> pa.ListArray:
        ends = np.frombuffer(self._ends, np.int64) // 4
        flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(self._data)])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)

    def binaries(self) -> pa.Array:
        ends = np.frombuffer(self._ends, np.int64).astype(np.int32)
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(self._data)]
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids (array of int) of a text; those of a NULL text are those of an empty one: none."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        codec = _codec(path, pattern)
        found = _Grown()
        for value in texts:
            found.add(codec.encode(value.as_py() or ""))
        return found.lists()

    return ids_of(text)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of the ids of a text and ``decoded``, the bytes of those ids, in one pass."""
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    @F.arrow_udf("ids array<int>, decoded binary")
    def there_and_back(texts: pa.Array) -> pa.Array:
        codec = _codec(path, pattern)
        found, decoded = _Grown(), _Grown()
        for value in texts:
            ids = codec.encode(value.as_py() or "")
            found.add(ids)
            decoded.add(codec.decode(ids))
        return pa.StructArray.from_arrays([found.lists(), decoded.binaries()], fields=list(kind))

    return there_and_back(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes that token ids stand for; NULL ids give no bytes. Unknown ids raise."""

    @F.arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        codec = _codec(path, pattern)
        none = np.zeros(0, np.int32)
        each = (value.values.to_numpy() if value.is_valid else none for value in lists)
        return pa.array([codec.decode(ids) for ids in each], pa.binary())

    return bytes_of(ids)
