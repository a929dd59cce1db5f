"""Bronze rows cleaned and typed into the five keyed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakemart.domain.cards import schemas as sc
from lakemart.functions.dates import in_rolling_window, partition_columns
from lakemart.functions.text import (
    BRACES,
    PARENS,
    bracket_text,
    list_category,
    normalise_columns,
    split_head_tail,
    strip_list_marks,
    symbol_count,
    symbol_labels,
)
from lakemart.functions.values import (
    blank_to_default,
    code_translate,
    content_key,
    empty_to_default,
    null_default,
    optional_column,
    parse_date,
    parse_float,
    parse_timestamp,
    trimmed_blank_to_default,
)
from lakemart.operators.chain import attach_canonical, ended_at, latest_edges, walks
from lakemart.operators.closure import update_closure
from lakemart.plans.lineage import cut_lineage


def _moment(df: DataFrame, name: str) -> Column:
    is_text = isinstance(df.schema[name].dataType, StringType)
    return parse_timestamp(F.col(name)) if is_text else F.col(name)


def _lineage(df: DataFrame, source: Column | None = None, ingested: Column | None = None) -> dict:
    return {
        "DT_INGESTAO": _moment(df, "ingestion_timestamp") if ingested is None else ingested,
        "NME_FONTE": trimmed_blank_to_default(F.col("source")) if source is None else source,
        "DESC_URL_ORIGEM": F.col("endpoint"),
        "DESC_ARQUIVO_ORIGEM": F.col("source_file"),
        "ID_EXECUCAO_BRONZE": F.col("bronze_run_id"),
        "DT_INGESTAO_BRONZE": F.col("bronze_ingestion_timestamp"),
    }


def _contract(df: DataFrame, columns: dict[str, Column], names: list[str]) -> DataFrame:
    return df.select(*[columns[name].alias(name) for name in names])


def cards(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of the last 60 months; colours, types and rules text made readable."""
    df = df.filter(in_rolling_window(_moment(df, "ingestion_timestamp"), as_of))
    head, tail = split_head_tail(F.col("type"))
    cost = bracket_text(blank_to_default(F.col("manaCost")))
    colours = empty_to_default(strip_list_marks(F.col("colors")), "Colorless")
    columns = _lineage(df, source=F.col("source")) | {
        "ID_CARTA": F.col("id"),
        "ID_ORACLE": optional_column(df, "oracle_id", "string"),
        "NME_CARTA": F.col("name"),
        "DESC_CUSTO_MANA": cost,
        "QTD_CUSTO_MANA": F.coalesce(F.col("cmc"), F.lit(0).cast("float")),
        "COD_CORES": colours,
        "COD_IDENTIDADE_COR": strip_list_marks(F.col("colorIdentity")),
        "NME_TIPO_CARTA": head,
        "DESC_DETALHE_TIPO_CARTA": tail,
        "DESC_TIPOS": empty_to_default(F.col("types")),
        "DESC_SUBTIPOS": empty_to_default(strip_list_marks(F.col("subtypes"))),
        "NME_RARIDADE": F.col("rarity"),
        "COD_COLECAO": F.upper("set"),
        "NME_COLECAO": F.col("setName"),
        "DESC_CARTA": symbol_labels(blank_to_default(F.col("text"))),
        "NME_ARTISTA": F.col("artist"),
        "NUM_COLECIONADOR": F.col("number"),
        "NME_FORCA": null_default(F.col("power"), "0"),
        "NME_RESISTENCIA": null_default(F.col("toughness"), "0"),
        "NME_DISPOSICAO_CARTA": F.col("layout"),
        "ID_MULTIVERSO": F.col("multiverseid"),
        "URL_IMAGEM": F.col("imageUrl"),
        "COD_VARIACOES": strip_list_marks(F.col("variations")),
        "DESC_NOMES_ESTRANGEIROS": bracket_text(F.col("foreignNames")),
        "DESC_IMPRESSOES": strip_list_marks(F.col("printings")),
        "DESC_CARTA_ORIGINAL": bracket_text(F.col("originalText")),
        "NME_TIPO_ORIGINAL": F.col("originalType"),
        "DESC_LEGALIDADES": bracket_text(F.col("legalities")),
        "NME_CATEGORIA_COR": list_category(colours),
        "QTD_CORES": symbol_count(cost),
    }
    columns |= partition_columns(columns["DT_INGESTAO"], names=("ANO_INGESTAO", "MES_INGESTAO"))
    titled = (
        "NME_CARTA NME_ARTISTA NME_RARIDADE NME_COLECAO NME_FORCA NME_RESISTENCIA DESC_SUBTIPOS "
        "DESC_TIPOS NME_TIPO_CARTA DESC_DETALHE_TIPO_CARTA NME_TIPO_ORIGINAL NME_CATEGORIA_COR"
    )
    return normalise_columns(_contract(df, columns, sc.CARDS), titled.split())


def sets(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    released = parse_date(F.col("releaseDate"))
    columns = _lineage(df, ingested=F.col("ingestion_timestamp")) | {
        "COD_COLECAO": F.upper("code"),
        "NME_COLECAO": F.col("name"),
        "NME_TIPO_COLECAO": F.col("type"),
        "NME_COR_BORDA": F.col("border"),
        "ID_CARDMARKET": F.col("mkm_id"),
        "NME_CARDMARKET": F.col("mkm_name"),
        "DT_LANCAMENTO": released,
        "COD_GATHERER": F.col("gathererCode"),
        "COD_MAGICCARDSINFO": F.col("magicCardsInfoCode"),
        "COD_ANTIGO": F.col("oldCode"),
        "FLG_SOMENTE_ONLINE": optional_column(df, "onlineOnly", "boolean"),
        "QTD_CARTAS": F.col("card_count"),
        "COD_COLECAO_PAI": F.upper("parent_set_code"),
        "NME_BLOCO": F.col("block"),
        "URL_ICONE": F.col("icon_svg_uri"),
    }
    columns |= {f"DESC_BOOSTER_SLOT_{i}": F.col(f"booster_{i}") for i in range(20)}
    columns |= partition_columns(released, names=("ANO_LANCAMENTO", "MES_LANCAMENTO"))
    titled = "NME_COLECAO NME_TIPO_COLECAO NME_CARDMARKET NME_COR_BORDA NME_BLOCO NME_FONTE"
    return normalise_columns(_contract(df, columns, sc.SETS), titled.split())


def prices(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """A missing or malformed price is NULL, never 0."""
    columns = _lineage(df) | {
        "ID_CARTA": F.col("id"),
        "NME_CARTA": F.col("name"),
        "COD_COLECAO": F.upper("set"),
        "NME_RARIDADE": F.col("rarity"),
        "URL_SCRYFALL": F.col("scryfall_uri"),
        "URL_IMAGEM": F.col("image_url"),
        "DT_LANCAMENTO": parse_date(F.col("releaseDate")),
    }
    columns |= {name: parse_float(F.col(name.removeprefix("VLR_").lower())) for name in sc.PRICE_VALUES}
    columns |= partition_columns(columns["DT_INGESTAO"], names=("ANO_INGESTAO", "MES_INGESTAO"))
    return normalise_columns(
        _contract(df, columns, sc.PRICES), ["NME_CARTA", "NME_RARIDADE", "NME_FONTE"]
    )


def rulings(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The key hashes the raw text; the feed's ``source`` is the emitter, not the lineage."""
    published = parse_date(F.col("published_at"))
    text = trimmed_blank_to_default(bracket_text(F.trim("comment")))
    columns = _lineage(df, source=F.lit(sc.SOURCE)) | {
        "ID_ESCLARECIMENTO": content_key(F.col("oracle_id"), published, F.col("comment")),
        "ID_ORACLE": F.col("oracle_id"),
        "NME_EMISSOR": code_translate(F.col("source"), sc.EMITTERS),
        "DT_PUBLICACAO": published,
        "DESC_ESCLARECIMENTO": text,
    }
    columns |= partition_columns(published, names=("ANO_PUBLICACAO", "MES_PUBLICACAO"))
    return normalise_columns(_contract(df, columns, sc.RULINGS), ["NME_EMISSOR", "NME_FONTE"])


def migrations(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Rename events, without their final ids (see ``with_canonical``)."""
    performed = parse_date(F.col("performed_at"))
    note = trimmed_blank_to_default(bracket_text(F.trim("note"), order=(PARENS, BRACES)))
    columns = _lineage(df) | {
        "ID_MIGRACAO": F.col("id"),
        "URL_SCRYFALL": F.col("uri"),
        "DT_EXECUCAO": performed,
        "NME_ESTRATEGIA_MIGRACAO": code_translate(F.col("migration_strategy"), sc.STRATEGIES),
        "ID_CARTA_ANTIGO": F.col("old_scryfall_id"),
        "ID_CARTA_NOVO": F.col("new_scryfall_id"),
        "DESC_NOTA": note,
        "ID_CARTA_ASSOCIADA": F.col("metadata_id"),
        "COD_IDIOMA": F.col("metadata_lang"),
        "NME_CARTA_ASSOCIADA": F.col("metadata_name"),
        "COD_COLECAO_ASSOCIADA": F.upper("metadata_set_code"),
        "ID_ORACLE_ASSOCIADO": F.col("metadata_oracle_id"),
        "NUM_COLECIONADOR_ASSOCIADO": F.col("metadata_collector_number"),
    }
    columns |= partition_columns(performed, names=("ANO_EXECUCAO", "MES_EXECUCAO"))
    names = [c for c in sc.MIGRATIONS if c != "ID_CARTA_CANONICO"]
    return normalise_columns(_contract(df, columns, names), ["NME_CARTA_ASSOCIADA", "NME_FONTE"])


def with_canonical(
    batch: DataFrame, stored: DataFrame | None = None, cut=cut_lineage, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The batch with final ids, and the walks (old, path) that gave them.

    Edges come from the batch and the stored events. ``known`` are the walks of the last run:
    only those that a changed edge reaches are taken again. ``cut`` writes what is used more
    than once.
    """
    batch = cut(batch, "moves")
    needed = ["NME_ESTRATEGIA_MIGRACAO", "ID_CARTA_ANTIGO", "ID_CARTA_NOVO", "DT_EXECUCAO", "ID_MIGRACAO"]
    events = batch.select(*needed)
    if stored is not None:
        events = events.union(stored.select(*needed))
    merges = events.filter(F.col("NME_ESTRATEGIA_MIGRACAO") == sc.STRATEGIES["merge"])
    edges = cut(latest_edges(merges, "ID_CARTA_ANTIGO", "ID_CARTA_NOVO", ["DT_EXECUCAO", "ID_MIGRACAO"]), "edges")
    if known is None:
        paths = walks(edges)
    else:
        before = known.select("old", F.col("path")[0].alias("new"))
        paths = update_closure(known, before, edges, cut=cut)
    paths = cut(paths, "walks")
    # Both sides are written tables or shuffled for the join, so a hot id can be split.
    resolved = attach_canonical(batch, ended_at(paths), "ID_CARTA_ANTIGO", "ID_CARTA_CANONICO", hot=[])
    return resolved.select(*sc.MIGRATIONS), paths
