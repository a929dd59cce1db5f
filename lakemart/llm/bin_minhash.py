"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each shingle of ``size`` words is hashed once. The top bits of a hash choose a bin, and the
smallest hash of each bin is kept: one sort of the hashes puts it first in its bin. An
empty bin takes the value of a bin that isn't empty, the first one in an order of the bins that
is the empty bin's own and the same for all texts, so that two texts agree in a bin with the
probability of their similarity whether it was empty or not. The lowest bits of each
bin's value are packed; agreement by chance of so few bits is taken out of a likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.ranking import ranked
from lakemart.plans.lineage import cut_lineage

#: Words of a shingle; bins as a power of two; bits kept of each bin's value.
SHINGLE = 5
BIN_BITS = 7
KEPT_BITS = 8
_BINS = 1 << BIN_BITS
_PER_WORD = 64 // KEPT_BITS
_WORDS = _BINS // _PER_WORD
#: One bit in each packed value.
_ONES = sum(1 << KEPT_BITS * k for k in range(_PER_WORD))
_SPACE = "[ \\t\\n\\x0B\\f\\r]+"
#: Bins that an empty bin looks at one by one before it looks at all that aren't empty.
TRIES = 24
#: Copies of a row that one task writes at once.
COPIES = 1000


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def _step(b: Column) -> Column:
    """An odd number of a bin's own: taken times it, all bins come in an order of that bin's own."""
    return F.hash(b).bitwiseAND(F.lit(_BINS - 2)).bitwiseOR(F.lit(1))


def _start(b: Column) -> Column:
    return F.shiftrightunsigned(F.hash(b), 12)


def _other(b: Column, k: int) -> Column:
    """The bin that bin ``b`` looks at in the k-th place."""
    return (_step(b) * k + _start(b)).bitwiseAND(F.lit(_BINS - 1))


def _inverse(step: Column) -> Column:
    """The odd number that times ``step`` is 1 modulo the number of bins."""
    # Newton's steps double the low bits that are right; an odd number is its inverse in three.
    inverse, right = step, 3
    while right < BIN_BITS:
        inverse, right = (inverse * (2 - step * inverse)).bitwiseAND(F.lit(_BINS - 1)), 2 * right
    return inverse


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _shingles(text: Column) -> Column:
    """Hashes of the shingles of a text; one of all its words if they are fewer, none without words."""
    words = F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "")

    def hashes(each: Column) -> Column:
        n = F.size(each)
        many = F.transform(
            F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(F.get(each, i + k) for k in range(SHINGLE)))
        )
        few = F.when(n > 0, F.array(F.xxhash64(F.array_join(each.cast("array<string>"), " ")))).otherwise(F.array().cast("array<long>"))
        return F.when(n >= SHINGLE, many).otherwise(few)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def _bin(value: Column) -> Column:
    """Top bits of a hash; bins ascend as signed longs do."""
    return (F.shiftright(value, 64 - BIN_BITS) + _BINS // 2).cast("int")


def _bins(hashes: Column) -> Column:
    """The smallest hash of each bin by bin, from an array that isn't empty."""
    def firsts(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(ordered, i - 1))))

    def nothing(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("long"), n)

    def laid_out(values: Column) -> Column:
        """Values at the place of their bin, NULL at those of empty bins."""

        def with_gap(x: Column, i: Column) -> Column:
            following = F.coalesce(_bin(F.get(values, i + 1)), F.lit(_BINS))
            return F.concat(F.array(x), nothing(following - _bin(x) - 1))

        return F.concat(nothing(_bin(values[0])), F.flatten(F.transform(values, with_gap)))

    def filled(values: Column) -> Column:
        def of(table: Column) -> Column:
            def one(x: Column, b: Column) -> Column:
                tries = [F.get(table, _other(b, k)) for k in range(TRIES)]
                # With few bins that aren't empty: the place of each in this bin's order, the first wins.
                own = F.struct(_inverse(_step(b)).alias("inverse"), _start(b).alias("start"))

                def first(o: Column) -> Column:
                    def place(v: Column, i: Column) -> Column:
                        at = (_bin(v) - o["start"]).bitwiseAND(F.lit(_BINS - 1)) * o["inverse"]
                        return at.bitwiseAND(F.lit(_BINS - 1)) * _BINS + i

                    return F.get(values, F.array_min(F.transform(values, place)).bitwiseAND(F.lit(_BINS - 1)))

                rest = _let(own, first)
                return F.coalesce(x, *tries, rest)

            return F.transform(table, one)

        return _let(laid_out(values), of)

    return _let(_let(F.sort_array(hashes), firsts), filled)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint of a text as an array of longs, NULL for one without words."""
    low = (1 << KEPT_BITS) - 1

    def packed(values: Column) -> Column:
        def word(k: Column) -> Column:
            part = F.slice(values, k * _PER_WORD + 1, F.lit(_PER_WORD))
            return F.aggregate(
                part,
                F.lit(0).cast("long"),
                lambda out, x: F.shiftleft(out, KEPT_BITS).bitwiseOR(x.bitwiseAND(F.lit(low).cast("long"))),
            )

        return F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), word)

    found = _let(_shingles(text), lambda h: F.when(F.size(h) > 0, _let(_bins(h), packed)))
    return found


def as_text(prints: Column) -> Column:
    """A fingerprint as hexadecimal digits; that of a text without words is empty."""
    digits = F.transform(prints, lambda word: F.lower(F.lpad(F.hex(word), 16, "0")))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity, 0 to 1, of the shingle sets of two fingerprints.

    Bins of different texts agree by chance in one of 2^KEPT_BITS cases; that share is taken out.
    Two texts without words are equal, one is like no other.
    """
    differing = None
    for k in range(_WORDS):
        x = a[k].bitwiseXOR(b[k])
        any_bit = x
        for bit in range(1, KEPT_BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, bit))
        count = F.bit_count(any_bit.bitwiseAND(_signed(_ONES)))
        differing = count if differing is None else differing + count
    chance = 1 / (1 << KEPT_BITS)
    corrected = ((1 - differing / _BINS) - chance) / (1 - chance)
    found = F.when(a.isNotNull() & b.isNotNull(), F.greatest(corrected, F.lit(0.0)))
    return found.when(a.isNull() & b.isNull(), 1.0).otherwise(0.0)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(k1, k2, id, text) of ``docs``; equal rows have equal keys, which are never NULL, so that
    grouping and joins by them need one shuffle."""
    whole = F.coalesce(F.col(text), F.lit(""))
    nameless = F.col(doc_id).isNull()
    return docs.select(
        F.xxhash64(F.lit(1), nameless, F.col(doc_id), whole).alias("k1"),
        F.xxhash64(whole, F.col(doc_id), nameless).alias("k2"),
        F.col(doc_id).alias("id"),
        whole.alias("text"),
    )


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, id, n, before_k1, before_k2, wanted): whom each text stands next to.

    The row before is the one this row's text is the next of, ``wanted`` how much of it that
    one takes; ``n`` counts equal rows. The first row stands next to the last.
    """
    keys = _keyed(docs, doc_id, text).groupBy("k1", "k2").agg(
        F.max("id").alias("id"), F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("chars")
    )
    keys = cut_lineage(keys, "texts")
    by = [F.col("id").desc_nulls_last(), F.col("k2").asc(), F.col("k1").asc()]
    placed = cut_lineage(ranked(keys, [], by), "ranked")
    before = placed.select(
        F.pmod(F.col("rank") + 1, F.col("size")).alias("rank"),
        F.col("k1").alias("before_k1"),
        F.col("k2").alias("before_k2"),
        F.floor(F.col("chars") / 2).cast("int").alias("wanted"),
    )
    return cut_lineage(placed.select("rank", "k1", "k2", "id", "n").join(before, "rank").drop("rank"), "neighbours")


def edited_pairs(docs: DataFrame, places: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited, prints, edited_prints, next_prints, copies) of the texts of ``docs``.

    ``edited`` is the text with its last half replaced by as much of the beginning of the next
    one: rows by descending id (NULL last), then a hash of the text; the first comes after the
    last. NULL is an empty text. Equal rows stand next to each other: all but the last of them are
    edited with their own text. They are one row here, ``copies`` counts them, so very many of
    them are no large group. Other columns are not read. ``places`` are the ``neighbours``.

    A text moves once, with its fingerprint, and the part that the one before takes moves on.
    """
    rows = _keyed(docs, doc_id, text).withColumn("prints", fingerprint(F.col("text")))
    texts = rows.groupBy("k1", "k2").agg(*(F.any_value(c).alias(c) for c in ("text", "prints")))
    # Both uses of ``texts`` need the same columns, so Spark shuffles them once.
    given = texts.join(places, ["k1", "k2"]).select(
        F.col("before_k1").alias("k1"),
        F.col("before_k2").alias("k2"),
        F.substring("text", F.lit(1), F.col("wanted")).alias("other"),
        F.col("prints").alias("other_prints"),
    )
    met = texts.join(given, ["k1", "k2"]).join(places.select("k1", "k2", "id", "n"), ["k1", "k2"])
    half = F.floor(F.length("text") / 2).cast("int")
    own = F.struct(F.substring("text", F.lit(1), half).alias("other"), F.col("prints").alias("other_prints"), (F.col("n") - 1).alias("copies"))
    nearby = F.struct("other", "other_prints", F.lit(1).cast("long").alias("copies"))
    cases = F.explode(F.when(F.col("n") > 1, F.array(nearby, own)).otherwise(F.array(nearby)))
    told = met.select("id", "text", "prints", half.alias("half"), cases.alias("case"))
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("half"))
    edited = told.select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(kept, F.col("case.other")).alias("edited"),
        "prints",
        F.col("case.other_prints").alias("next_prints"),
        F.col("case.copies").alias("copies"),
    )
    return edited.withColumn("edited_prints", fingerprint(F.col("edited")))


def repeated(rows: DataFrame, copies: str, most: int) -> DataFrame:
    """Each row as often as ``copies`` says, ``most`` at most; very many by several tasks."""
    last = (F.col(copies) - 1).cast("long")
    if most > COPIES:
        chunks = F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES).cast("long"))
        rows = rows.withColumn("_part", F.explode(chunks)).hint("rebalance")
        last = F.least(F.lit(COPIES - 1).cast("long"), last - F.col("_part") * COPIES)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_part", "_copy", copies)
