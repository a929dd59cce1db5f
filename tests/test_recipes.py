"""How the card-market recipes spread their work; their results are held against the twins elsewhere."""

import pytest
from pyspark.sql import functions as F

from lakemart.functions.values import parse_float
from lakemart.operators import dimension, skew
from lakemart.queries import QUERIES, recipes
from lakemart.queries.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "text, want",
    [("12.5", 12.5), (" 7 ", 7.0), ("1e3", 1000.0), ("Infinity", float("inf")), ("-INF", float("-inf")),
     ("n/a", None), ("", None), (None, None), ("banana", None), ("x1", None), ("true", None)],
)
def test_texts_that_cannot_be_numbers(one, text, want):
    assert one(parse_float(F.col("c")), row=(text,)) == want


def test_only_numbers_are_parsed_as_before(one):
    assert one(parse_float(F.col("c")), "c boolean", (True,)) == 1.0
    assert str(one(parse_float(F.col("c")), row=("NaN",))) == "nan"


def test_prices_are_dealt_by_number_and_sorted_once(spark):
    """Tasks are not sized by the few bytes of a quote; nothing is grouped or sorted before a shuffle."""
    text = plan(QUERIES["recipe_prices"](spark, FOLDER))
    assert text.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in text
    assert text.count("Sort [") == 1


def test_rulings_of_the_dimension_leave_texts_behind(spark):
    t = Tables(spark, FOLDER)
    narrow = recipes.silver_rulings(t, ["ID_ESCLARECIMENTO", "ID_ORACLE", "DT_PUBLICACAO", "DT_INGESTAO"])
    whole = recipes.silver_rulings(t).select(*narrow.columns)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.collect()))
    shuffled = plan(narrow).split("Window [")[1]
    assert "DESC_ESCLARECIMENTO" not in shuffled and "NME_EMISSOR" not in shuffled


def test_cards_are_dealt_before_they_are_cleaned(spark):
    below = plan(recipes.silver_cards(Tables(spark, FOLDER))).split("from_json(")[-1]
    assert "REPARTITION_BY_COL" in below


def test_fact_computes_its_quotes_once(spark, monkeypatch):
    asked, real = [], skew.hot_keys

    def seen(df, key, *args):
        asked.append(key)
        return real(df, key, *args)

    monkeypatch.setattr(skew, "hot_keys", seen)
    monkeypatch.setattr(dimension, "hot_keys", seen)
    fact = QUERIES["recipe_fact"](spark, FOLDER)
    assert "ID_CARTA" not in asked
    # The quotes' own shuffle by card serves the join too.
    assert plan(fact).count("REPARTITION_BY_NUM") == 2
