"""Text cleaning as native column expressions; no Python runs per row."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The null sentinel and the symbol labels of the card texts.
NA = "NA"
SYMBOL_LABELS = [
    ("{W}", "[White]"),
    ("{U}", "[Blue]"),
    ("{B}", "[Black]"),
    ("{R}", "[Red]"),
    ("{G}", "[Green]"),
    ("{C}", "[Colorless]"),
    ("{X}", "[X]"),
    ("{T}", "[Tap]"),
    ("{Q}", "[Untap]"),
    ("{S}", "[Snow]"),
    ("{E}", "[Energy]"),
]
BRACES = (r"\{([^}]*)\}", "[$1]")
PARENS = (r"\(([^)]*)\)", "[$1]")
LIST_MARKS = r"[\[\]\"]"


@cache
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Code points whose NFKD form holds ASCII: one character, and several.

    NFKD works per code point and only reorders combining marks, which are never
    ASCII, so folding each character on its own is exact.
    """
    single, multiple = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            single[ch] = folded
        elif folded:
            multiple[ch] = folded
    return single, multiple


@cache
def _multiple_class() -> str:
    """Regex class covering the several-character folds in a few wide ranges.

    A class of hundreds of single characters is slow to match, so near neighbours
    share a range; whatever else falls into a range folds to itself.
    """
    points = sorted(ord(c) for c in _ascii_folds()[1])
    ranges = [[points[0], points[0]]]
    for cp in points[1:]:
        if cp - ranges[-1][1] <= (0x400 if cp >= 0x2000 else 0x40):
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _fold_multiple(text: Column) -> Column:
    """Expand ligatures, fractions and the like; loops only over those present."""
    _, multiple = _ascii_folds()
    # One literal instead of a node per entry keeps the plan small.
    table = F.from_json(F.lit(json.dumps(multiple)), "map<string,string>")
    present = F.array_distinct(F.regexp_extract_all(text, F.lit(_multiple_class()), F.lit(0)))
    expanded = F.aggregate(
        present, text, lambda acc, ch: F.replace(acc, ch, F.coalesce(table[ch], ch))
    )
    return F.when(text.rlike(_multiple_class()), expanded).otherwise(text)


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and keep only the ASCII part; NULL stays NULL.

    Plain ASCII is recognised by its length in bytes. Text whose other characters
    all fold to one letter, the usual case, takes a single character mapping.
    """
    single, _ = _ascii_folds()
    accented, letters = "".join(single), "".join(single.values())
    ascii_only = F.octet_length(c) == F.char_length(c)
    unusual = F.translate(F.regexp_replace(c, r"[\x00-\x7F]+", ""), accented, "")
    everything = F.regexp_replace(
        F.translate(_fold_multiple(c), accented, letters), r"[^\x00-\x7F]+", ""
    )
    return (
        F.when(ascii_only, c)
        .when(unusual == "", F.translate(c, accented, letters))
        .otherwise(everything)
    )


def normalise_text(c: Column) -> Column:
    """``mana vermelha`` to ``Mana_Vermelha``; NULL, blank and 'NA' pass as they are."""
    titled = F.replace(F.initcap(strip_accents(F.trim(c))), F.lit(" "), F.lit("_"))
    passes = c.isNull() | (F.trim(c) == "") | (c == NA)
    return F.when(passes, c).otherwise(titled)


def normalise_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({name: normalise_text(F.col(name)) for name in columns})


def strip_list_marks(c: Column) -> Column:
    return F.regexp_replace(c, LIST_MARKS, "")


def bracket_text(c: Column, order=(BRACES, PARENS)) -> Column:
    """Turn ``{x}`` and ``(x)`` into ``[x]``."""
    return reduce(lambda acc, rule: F.regexp_replace(acc, *rule), order, c)


def symbol_labels(c: Column, labels=SYMBOL_LABELS) -> Column:
    """Named tokens first, then every remaining ``{x}`` and ``(x)``."""
    named = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), labels, c)
    if not all(token.startswith("{") for token, _ in labels):
        return bracket_text(named)
    # Most texts have neither mark; one search then stands for all the passes.
    parens_only = F.when(c.contains("("), F.regexp_replace(c, *PARENS)).otherwise(c)
    return F.when(c.contains("{"), bracket_text(named)).otherwise(parens_only)


def split_head_tail(
    c: Column, delimiter: str = "—", special: str = "planeswalker", default: str = NA
) -> tuple[Column, Column]:
    """Head and tail around the first delimiter.

    A line holding ``special`` keeps that word as head and the whole line as tail.
    """
    blank = c.isNull() | (F.trim(c) == "")
    is_special = F.contains(F.lower(c), F.lit(special.lower()))
    at = F.instr(c, F.lit(delimiter))
    before = F.trim(F.substring_index(c, delimiter, 1))
    after = F.trim(F.substring(c, at + len(delimiter), F.length(c)))
    head = (
        F.when(blank, default)
        .when(is_special, special.capitalize())
        .when(at > 0, before)
        .otherwise(F.trim(c))
    )
    tail = F.when(blank, default).when(is_special, c).when(at > 0, after).otherwise(default)
    return head, tail


def list_category(c: Column, none_value: str = "Colorless") -> Column:
    """Name for the number of entries of a comma list."""
    n = F.size(F.split(c, ","))
    # The categories.
    return (
        F.when(c == none_value, none_value)
        .when(n == 2, "Dual Color")
        .when(n >= 3, "Multicolor")
        .otherwise("Mono")
    )


def symbol_count(c: Column, letters: str = "WUBRG") -> Column:
    """How many characters of ``letters`` the text holds, repeats counted."""
    kept = F.length(F.regexp_replace(F.upper(c), f"[^{letters}]+", ""))
    return F.when(c.isNull() | (c == NA), 0).otherwise(kept)
