"""BPE codec and token counts against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm.bpe_codec import Codec, decode, encode, read_ranks
from lakemart.llm.queries_tokens import digests
from lakemart.llm.text_segments import Memo, segments
from lakemart.llm.token_counts import Counter, byte_batches, safe_parts, token_count

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab zZ \n\t  \r\x0b\x1c\x85\xa0    éß1٣²’'s'll!?…日本語😀\u0301\x00"
HARD = ["", " ", "  ", "a  b", " \n \n x", "x \n ", "it's 'll 've", "a" * 30000, "ab" * 9000, "\n" * 999 + " x"]


def texts(n, seed, extra=()):
    pick = random.Random(seed)
    letters = [*ALPHABET, *extra]
    return ["".join(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return Codec(read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}
    )


def test_ids_are_the_librarys(codec, library):
    for text in HARD + texts(4000, 1):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_every_code_point_splits_alike(codec, library):
    for i in [*range(0x3100), *range(0xFE00, 0x10000), *range(0x1F600, 0x1F650)]:
        text = f"{chr(i)}a1{chr(i)} {chr(i)}!" if not 0xD800 <= i < 0xE000 else ""
        assert codec.encode(text).tolist() == library.encode_ordinary(text), hex(i)


def test_compatibility_is_that_of_the_merges(codec):
    pick = random.Random(3)
    for _ in range(20000):
        left, right = pick.randrange(50256), pick.randrange(3000)
        pair = [codec._token[left], codec._token[right]]
        assert codec._compatible(left, right) == (codec._merged("".join(pair)) == pair)


def test_round_trip_and_unknown_ids(codec):
    for text in HARD + texts(500, 2):
        assert codec.decode(codec.encode(text)) == text.encode()
    with pytest.raises(ValueError):
        codec.decode(np.array([50256]))
    with pytest.raises(ValueError):
        codec.decode(np.array([-1]))


def test_cuts_keep_the_text():
    for text in HARD + texts(500, 4):
        first, rest = segments(text)
        assert first + "".join(f" {part}" for part in rest) == text
        assert "".join(safe_parts(text, 7)) == text


def test_memo_forgets_and_recomputes():
    memo = Memo(lambda keys: [key * 2 for key in keys], 6)
    for _ in range(3):
        keys = [str(i % 11) for i in range(50)]
        assert memo.of(keys) == [key * 2 for key in keys]


def test_batches_are_of_equal_bytes():
    batches = list(byte_batches(["aa", "é", "x" * 20, "b", "c"], 4))
    assert batches == [["aa", "é"], ["x" * 20], ["b", "c"]]


def test_counts_are_the_librarys():
    model, counter = Tokenizer.from_file(JSON), Counter(JSON)
    for text in HARD + texts(3000, 5, ["<|endoftext|>"]):
        assert counter.count(text) == len(model.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_are_counted_whole(name):
    import sentencepiece

    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        model = Tokenizer.from_file(path)
        length = lambda text: len(model.encode(text, add_special_tokens=False))
    else:
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        length = lambda text: len(pieces.encode(text))
    counter = Counter(path)
    for text in texts(200, 6):
        assert counter.count(text) == length(text)


def test_columns(spark, library):
    rows = [(1, None), (2, ""), (3, "Hello  world's 123"), (3, "Hello  world's 123"), (None, "x" * 100000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", F.lit("old"))
    got = digests(docs).collect()
    for row, (doc_id, text) in zip(got, rows):
        ids = library.encode_ordinary(text or "")
        joined = " ".join(map(str, ids))
        assert row["doc_id"] == doc_id and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert digests(docs.where("doc_id < 0")).count() == 0
    counts = docs.select(token_count(F.col("text"), JSON).alias("n")).collect()
    assert [row["n"] for row in counts][:2] == [0, 0] and counts[2]["n"] == got[2]["n_tokens"]


def test_null_ids_decode_to_nothing(spark):
    row = spark.sql("select cast(null as array<int>) as ids")
    assert row.select(decode(F.col("ids"), RANKS, public_tokenizers.PATTERN)).first()[0] == b""
    text = spark.sql("select 'abc' as text")
    assert text.select(encode(F.col("text"), RANKS, public_tokenizers.PATTERN)).first()[0]
