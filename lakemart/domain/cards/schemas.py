"""Schemas and column contracts.

Fixed values: names, types and order are those of the feeds and of the tables
their consumers read.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

TEXT = StringType()
TEXTS = ArrayType(TEXT)
TEXT_MAP = MapType(TEXT, TEXT)


def _struct(text: str = "", **others) -> StructType:
    fields = [StructField(name, TEXT) for name in text.split()]
    return StructType(fields + [StructField(name, kind) for name, kind in others.items()])


def _listed(names: str, **kinds) -> StructType:
    """Columns in the order of ``names``: text, but for those whose kind is given."""
    return StructType([StructField(name, kinds.get(name, TEXT)) for name in names.split()])


# Feeds as they arrive.
FACE = _struct(
    "name mana_cost type_line oracle_text oracle_id artist power toughness",
    colors=TEXTS,
    image_uris=TEXT_MAP,
)
RAW_CARD = _struct(
    "id oracle_id name mana_cost type_line rarity set set_name oracle_text artist "
    "collector_number power toughness layout released_at scryfall_uri",
    cmc=DoubleType(),
    colors=TEXTS,
    color_identity=TEXTS,
    image_uris=TEXT_MAP,
    legalities=TEXT_MAP,
    prices=_struct("usd usd_foil usd_etched eur eur_foil tix"),
    card_faces=ArrayType(FACE),
)
# Flags and counts arrive as text so that a malformed one does not lose its record.
RAW_SET = _struct(
    "code name set_type released_at digital card_count parent_set_code block icon_svg_uri"
)
RAW_RULING = _struct("oracle_id source published_at comment")
RAW_MIGRATION = _struct(
    "id uri performed_at migration_strategy old_scryfall_id new_scryfall_id note",
    metadata=_struct("id lang name set_code oracle_id collector_number"),
)

# Snapshot rows.
STAGE = {
    "cards": _listed(
        "name manaCost cmc colors colorIdentity type types subtypes rarity set setName text artist "
        "number power toughness layout multiverseid imageUrl variations foreignNames printings "
        "originalText originalType legalities id oracle_id",
        cmc=FloatType(),
        multiverseid=IntegerType(),
    ),
    "sets": _listed(
        "code name type border mkm_id mkm_name releaseDate gathererCode magicCardsInfoCode booster "
        "oldCode onlineOnly source card_count parent_set_code block icon_svg_uri booster_0 booster_1 "
        "booster_2 booster_3 booster_4 booster_5 booster_6 booster_7 booster_8 booster_9 booster_10 "
        "booster_11 booster_12 booster_13 booster_14 booster_15 booster_16 booster_17 booster_18 "
        "booster_19",
        mkm_id=IntegerType(),
        onlineOnly=BooleanType(),
        card_count=IntegerType(),
    ),
    "card_prices": _struct(
        "id name set rarity usd usd_foil usd_etched eur eur_foil tix scryfall_uri image_url "
        "releaseDate"
    ),
    "rulings": _struct("oracle_id source published_at comment"),
    "migrations": _struct(
        "id uri performed_at migration_strategy old_scryfall_id new_scryfall_id note "
        "metadata_id metadata_lang metadata_name metadata_set_code metadata_oracle_id "
        "metadata_collector_number"
    ),
}
MANDATORY = {
    "cards": ["id", "oracle_id", "name", "set", "rarity", "type"],
    "sets": ["code", "name", "releaseDate"],
    "card_prices": ["id", "set"],
    "rulings": ["oracle_id", "published_at", "comment"],
    "migrations": ["id", "performed_at", "migration_strategy", "old_scryfall_id"],
}
STAGE_LINEAGE = ["ingestion_timestamp", "source", "endpoint"]
BRONZE_LINEAGE = ["source_file", "bronze_run_id", "bronze_ingestion_timestamp"]


def bronze_columns(feed: str) -> list[str]:
    own = [c for c in STAGE[feed].fieldNames() if c not in STAGE_LINEAGE]
    return own + STAGE_LINEAGE + BRONZE_LINEAGE


# Keyed tables.
LINEAGE = (
    "DT_INGESTAO NME_FONTE DESC_URL_ORIGEM DESC_ARQUIVO_ORIGEM ID_EXECUCAO_BRONZE "
    "DT_INGESTAO_BRONZE"
).split()
CARDS = (
    "ID_CARTA ID_ORACLE NME_CARTA DESC_CUSTO_MANA QTD_CUSTO_MANA COD_CORES COD_IDENTIDADE_COR "
    "NME_TIPO_CARTA DESC_DETALHE_TIPO_CARTA DESC_TIPOS DESC_SUBTIPOS NME_RARIDADE COD_COLECAO "
    "NME_COLECAO DESC_CARTA NME_ARTISTA NUM_COLECIONADOR NME_FORCA NME_RESISTENCIA "
    "NME_DISPOSICAO_CARTA ID_MULTIVERSO URL_IMAGEM COD_VARIACOES DESC_NOMES_ESTRANGEIROS "
    "DESC_IMPRESSOES DESC_CARTA_ORIGINAL NME_TIPO_ORIGINAL DESC_LEGALIDADES NME_CATEGORIA_COR "
    "QTD_CORES ANO_INGESTAO MES_INGESTAO"
).split() + LINEAGE
SETS = (
    "COD_COLECAO NME_COLECAO NME_TIPO_COLECAO NME_COR_BORDA ID_CARDMARKET NME_CARDMARKET "
    "DT_LANCAMENTO COD_GATHERER COD_MAGICCARDSINFO COD_ANTIGO FLG_SOMENTE_ONLINE QTD_CARTAS "
    "COD_COLECAO_PAI NME_BLOCO URL_ICONE"
).split() + [f"DESC_BOOSTER_SLOT_{i}" for i in range(20)] + ["ANO_LANCAMENTO", "MES_LANCAMENTO"] + LINEAGE
PRICE_VALUES = "VLR_USD VLR_USD_FOIL VLR_USD_ETCHED VLR_EUR VLR_EUR_FOIL VLR_TIX".split()
PRICES = (
    ["ID_CARTA", "NME_CARTA", "COD_COLECAO", "NME_RARIDADE"]
    + PRICE_VALUES
    + ["URL_SCRYFALL", "URL_IMAGEM", "DT_LANCAMENTO", "ANO_INGESTAO", "MES_INGESTAO"]
    + LINEAGE
)
RULINGS = (
    "ID_ESCLARECIMENTO ID_ORACLE NME_EMISSOR DT_PUBLICACAO DESC_ESCLARECIMENTO "
    "ANO_PUBLICACAO MES_PUBLICACAO"
).split() + LINEAGE
MIGRATIONS = (
    "ID_MIGRACAO URL_SCRYFALL DT_EXECUCAO NME_ESTRATEGIA_MIGRACAO ID_CARTA_ANTIGO ID_CARTA_NOVO "
    "ID_CARTA_CANONICO DESC_NOTA ID_CARTA_ASSOCIADA COD_IDIOMA NME_CARTA_ASSOCIADA "
    "COD_COLECAO_ASSOCIADA ID_ORACLE_ASSOCIADO NUM_COLECIONADOR_ASSOCIADO ANO_EXECUCAO MES_EXECUCAO"
).split() + LINEAGE

# Mart.
DIM = (
    "ID_CARTA ID_ORACLE NME_CARTA NME_TIPO_CARTA NME_RARIDADE NME_CATEGORIA_COR COD_CORES "
    "QTD_CUSTO_MANA COD_COLECAO NME_COLECAO NME_BLOCO DT_LANCAMENTO_COLECAO QTD_ESCLARECIMENTOS "
    "DT_ULTIMO_ESCLARECIMENTO ID_CARTA_CANONICO FLG_ID_CARTA_MIGRADO"
).split()
FACT = (
    "ID_CARTA ID_ORACLE NME_CARTA NME_TIPO_CARTA NME_RARIDADE NME_CATEGORIA_COR COD_CORES "
    "QTD_CUSTO_MANA COD_COLECAO NME_COLECAO NME_BLOCO DT_LANCAMENTO_COLECAO DT_COTACAO VLR_USD "
    "VLR_USD_FOIL VLR_USD_ETCHED VLR_EUR VLR_EUR_FOIL VLR_TIX QTD_ESCLARECIMENTOS "
    "DT_ULTIMO_ESCLARECIMENTO ID_CARTA_CANONICO FLG_ID_CARTA_MIGRADO ANO_COTACAO MES_COTACAO"
).split()

UNKNOWN = "Nao_Identificado"
NO_DATE = "1001-01-01"
STRATEGIES = {"merge": "Unificacao", "delete": "Remocao"}
EMITTERS = {"wotc": "Wizards", "scryfall": "Scryfall"}
SOURCE = "scryfall"
