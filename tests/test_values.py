import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from lakemart.functions import values as v
from lakemart.functions.dates import in_rolling_window, partition_columns, release_cutoff
from lakemart.functions.paths import normalise_path, snapshot_name

C = F.col("c")


def test_blank_rules_differ_on_spaces(one):
    assert one(v.blank_to_default(C), row=("   ",)) == ""
    assert one(v.trimmed_blank_to_default(C), row=("   ",)) == "NA"
    assert one(v.empty_to_default(C), row=(" x ",)) == " x "
    for text in (None, ""):
        assert one(v.blank_to_default(C), row=(text,)) == "NA"
        assert one(v.trimmed_blank_to_default(C), row=(text,)) == "NA"
        assert one(v.empty_to_default(C, "Colorless"), row=(text,)) == "Colorless"


def test_malformed_values_are_null(one):
    for text in ("", "n/a", "1,5"):
        assert one(v.parse_float(C), row=(text,)) is None
    assert one(v.parse_float(C), row=("73.75",)) == 73.75
    for text in ("", "soon", "2024-13-01"):
        assert one(v.parse_date(C), row=(text,)) is None
    assert one(v.parse_date(C), row=("2024-02-29",)) == dt.date(2024, 2, 29)


def test_time_without_date_is_no_timestamp(one):
    assert one(v.parse_timestamp(C), row=("10:30:00",)) is None
    assert one(v.parse_timestamp(C), row=("2024-01-02 10:30:00",)) == dt.datetime(2024, 1, 2, 10, 30)


def test_widening_keeps_null(one):
    assert [one(v.widen_float(C), "c double", (x,)) for x in (0.0, 3.0, 1.5, None)] == [0.0, 3.0, 1.5, None]


def test_tolerant_cast_keeps_text(one):
    typed, kept = v.tolerant_cast(C, "int")
    assert (one(typed, row=("7",)), one(kept, row=("7",))) == (7, None)
    assert (one(typed, row=("many",)), one(kept, row=("many",))) == (None, "many")


def test_unknown_codes_pass(one):
    labels = {"merge": "Unificacao", "delete": "Remocao"}
    assert one(v.code_translate(C, labels), row=("merge",)) == "Unificacao"
    assert one(v.code_translate(C, labels), row=("split",)) == "split"
    assert one(v.code_translate(C, labels)) is None


def test_content_key(one):
    key = v.content_key(C, F.lit(None).cast("string"), F.lit("x"))
    assert one(key, row=("a",)) == hashlib.sha256(b"a||x").hexdigest()


def test_json_text_like_the_feed(one):
    entries = ['W"', "U", "a,b"]
    assert one(v.json_text_list(C), "c array<string>", (entries,)) == json.dumps(entries)
    assert one(v.json_text_list(C), "c array<string>", ([],)) == "[]"
    assert one(v.json_text_list(C), "c array<string>") is None
    legal = {"standard": "legal", "modern": "not_legal"}
    assert one(v.json_text_map(C), "c map<string,string>", (legal,)) == json.dumps(legal)


def test_windows(one):
    assert release_cutoff(dt.date(2026, 9, 5)) == dt.date(2021, 1, 1)
    recent = in_rolling_window(C, dt.date(2026, 9, 5))
    assert one(recent, "c date", (dt.date(2021, 9, 5),)) is True
    assert one(recent, "c date", (dt.date(2021, 9, 4),)) is False


def test_partition_fallback(one):
    parts = partition_columns(C, dt.date(2026, 9, 5))
    assert [one(p, "c date") for p in parts.values()] == [2026, 9]
    assert [one(p, "c date", (dt.date(2021, 3, 1),)) for p in parts.values()] == [2021, 3]


def test_snapshot_names(one):
    name = lambda day: snapshot_name(F.lit(2021), F.lit(3), day, "card_prices")
    assert one(name(dt.date(2026, 9, 5))) == "2021_03_20260905_card_prices.parquet"
    assert one(name(dt.date(2026, 10, 5))) != one(name(dt.date(2026, 9, 5)))


def test_path_of_folder_and_of_part_file_agree(one):
    folder = one(normalise_path(C), row=("s3://lake/stage/2026_09_15_cards.parquet",))
    part = one(normalise_path(C), row=("s3a://lake/stage/2026_09_15_cards.parquet/part-0.parquet",))
    assert folder == part == "lake/stage/2026_09_15_cards.parquet"
