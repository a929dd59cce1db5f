import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lakemart.functions import text as tx

C = F.col("c")


def folded(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


@pytest.mark.parametrize("text", ["São Paulo Ação", "½ ﬁn ½", "㍱ ⅷ ㏂", "ß ø Ł", "漢字 áb", "", "plain"])
def test_accents_match_compatibility_decomposition(one, text):
    assert one(tx.strip_accents(C), row=(text,)) == folded(text)


def test_accents_of_every_code_point(spark):
    points = [cp for cp in range(0x20, 0x20000) if not 0xD800 <= cp <= 0xDFFF]
    random.Random(1).shuffle(points)
    texts = ["".join(map(chr, points[i : i + 40])) for i in range(0, len(points), 40)]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select("c", tx.strip_accents(C).alias("o"))
    assert [r.c for r in rows.collect() if r.o != folded(r.c)] == []


def test_accents_null(one):
    assert one(tx.strip_accents(C)) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("MANA VERMELHA", "Mana_Vermelha"),
        ("Água", "Agua"),
        (None, None),
        ("", ""),
        ("   ", "   "),
        ("NA", "NA"),
        ("  dual  color ", "Dual__Color"),
        ("na", "Na"),
    ],
)
def test_normalise(one, text, want):
    assert one(tx.normalise_text(C), row=(text,)) == want


def test_symbols(one):
    assert one(tx.symbol_labels(C), row=("({T}: Add {G}.)",)) == "[[Tap]: Add [Green].]"
    assert one(tx.symbol_labels(C), row=("{2}{W/U} (x)",)) == "[2][W/U] [x]"
    cost = one(tx.bracket_text(C), row=("{2}{U}{U}",))
    assert cost == "[2][U][U]"
    assert one(tx.symbol_count(C), row=(cost,)) == 2
    assert one(tx.symbol_count(C), row=("[W/U]",)) == 2
    assert one(tx.symbol_count(C), row=("NA",)) == 0
    assert one(tx.symbol_count(C)) == 0


@pytest.mark.parametrize(
    "line, want",
    [
        ("Creature — Moss Tinker", ("Creature", "Moss Tinker")),
        ("Creature — Elf — Druid", ("Creature", "Elf — Druid")),
        ("Instant", ("Instant", "NA")),
        ("Legendary Planeswalker — Jace", ("Planeswalker", "Legendary Planeswalker — Jace")),
        (" ", ("NA", "NA")),
        (None, ("NA", "NA")),
    ],
)
def test_head_tail(one, line, want):
    head, tail = tx.split_head_tail(C)
    assert (one(head, row=(line,)), one(tail, row=(line,))) == want


@pytest.mark.parametrize(
    "colours, want",
    [("Colorless", "Colorless"), ("W", "Mono"), ("W, U", "Dual Color"), ("W, U, B", "Multicolor")],
)
def test_category(one, colours, want):
    assert one(tx.list_category(C), row=(colours,)) == want


def test_list_marks(one):
    assert one(tx.strip_list_marks(C), row=('["W", "U"]',)) == "W, U"
