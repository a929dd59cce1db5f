"""Feeds flattened to snapshot rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.domain.cards.schemas import STAGE
from lakemart.functions.values import (
    face_value,
    json_text_list,
    json_text_map,
    tolerant_cast,
    widen_float,
)


def _project(df: DataFrame, feed: str, columns: dict, keep=()) -> DataFrame:
    """The feed's fixed columns; those without a source are typed NULLs."""
    return df.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in STAGE[feed].fields
        ],
        *keep,
    )


def _same(names: str) -> dict:
    return {name: F.col(name) for name in names.split()}


def cards(raw: DataFrame) -> DataFrame:
    columns = _same("id name rarity set layout") | {
        "oracle_id": face_value("oracle_id"),
        "manaCost": face_value("mana_cost"),
        "cmc": widen_float(F.col("cmc")),
        "colors": json_text_list(face_value("colors")),
        "colorIdentity": json_text_list(F.col("color_identity")),
        "type": face_value("type_line"),
        "setName": F.col("set_name"),
        "text": face_value("oracle_text"),
        "artist": face_value("artist"),
        "number": F.col("collector_number"),
        "power": face_value("power"),
        "toughness": face_value("toughness"),
        "imageUrl": face_value("image_uris")["normal"],
        "legalities": json_text_map(F.col("legalities")),
    }
    return _project(raw, "cards", columns)


def _set_values():
    return tolerant_cast(F.col("digital"), "boolean"), tolerant_cast(F.col("card_count"), "int")


def unparsed_sets(raw: DataFrame) -> int:
    """Sets with a flag or count that does not parse; it becomes NULL, the run row counts it."""
    kept = [text.isNotNull() for _, text in _set_values()]
    return raw.where(kept[0] | kept[1]).count()


def sets(raw: DataFrame) -> DataFrame:
    """Flags are parsed as booleans: the text 'false' is false, not merely filled."""
    (online, _), (count, _) = _set_values()
    columns = _same("code name parent_set_code block icon_svg_uri") | {
        "type": F.col("set_type"),
        "releaseDate": F.col("released_at"),
        "onlineOnly": online,
        "card_count": count,
    }
    return _project(raw, "sets", columns)


def card_prices(raw: DataFrame, keep=()) -> DataFrame:
    """One row per printing; unlike elsewhere an empty image object counts as absent.

    ``keep`` names columns to carry beside the fixed ones.
    """
    root = F.col("image_uris")
    first = F.get(F.col("card_faces"), F.lit(0))["image_uris"]
    image = F.when(F.size(root) > 0, root).otherwise(first)
    columns = _same("id name set rarity scryfall_uri") | {
        "image_url": image["normal"],
        "releaseDate": F.col("released_at"),
    }
    for price in "usd usd_foil usd_etched eur eur_foil tix".split():
        columns[price] = F.col(f"prices.{price}")
    return _project(raw, "card_prices", columns, keep)


def rulings(raw: DataFrame) -> DataFrame:
    return _project(raw, "rulings", _same("oracle_id source published_at comment"))


def migrations(raw: DataFrame) -> DataFrame:
    """A missing metadata object gives NULL fields."""
    columns = _same(
        "id uri performed_at migration_strategy old_scryfall_id new_scryfall_id note"
    )
    for name in "id lang name set_code oracle_id collector_number".split():
        columns[f"metadata_{name}"] = F.col(f"metadata.{name}")
    return _project(raw, "migrations", columns)
