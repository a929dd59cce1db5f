"""Card dimension and market fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.domain.cards import schemas as sc
from lakemart.operators.dimension import Lookup, build_dim, build_fact, child_summary, latest_event
from lakemart.operators.quality import Check, any_negative, any_null
from lakemart.plans.mart import MartSpec

# Limit on quoted ids without a card, over a usual count of about 7,476.
ORPHAN_QUOTE_LIMIT = 12000


def dimension(
    cards: DataFrame,
    sets: DataFrame,
    rulings: DataFrame,
    migrations: DataFrame,
    hot_sets: list | None = None,
    hot_oracles: list | None = None,
) -> DataFrame:
    """Current cards. Sets and oracle ids of very many cards can be given, else they are looked for."""
    no_date = F.lit(sc.NO_DATE).cast("date")
    summary = child_summary(
        rulings, "ID_ORACLE", "DT_PUBLICACAO", "QTD_ESCLARECIMENTOS", "DT_ULTIMO_ESCLARECIMENTO"
    )
    latest = latest_event(
        migrations, "ID_CARTA_ANTIGO", ["DT_EXECUCAO", "ID_MIGRACAO"], ["ID_CARTA_CANONICO"]
    )
    lookups = [
        Lookup(
            sets,
            "COD_COLECAO",
            "COD_COLECAO",
            {
                "NME_COLECAO": "NME_COLECAO",
                "NME_BLOCO": "NME_BLOCO",
                "DT_LANCAMENTO": "DT_LANCAMENTO_COLECAO",
            },
            {
                "NME_COLECAO": F.lit(sc.UNKNOWN),
                "NME_BLOCO": F.lit(sc.UNKNOWN),
                "DT_LANCAMENTO_COLECAO": no_date,
            },
            hot=hot_sets,
        ),
        Lookup(
            summary,
            "ID_ORACLE",
            "ID_ORACLE",
            {
                "QTD_ESCLARECIMENTOS": "QTD_ESCLARECIMENTOS",
                "DT_ULTIMO_ESCLARECIMENTO": "DT_ULTIMO_ESCLARECIMENTO",
            },
            {"QTD_ESCLARECIMENTOS": F.lit(0), "DT_ULTIMO_ESCLARECIMENTO": no_date},
            hot=hot_oracles,
        ),
        Lookup(
            latest,
            "ID_CARTA",
            "ID_CARTA_ANTIGO",
            {"ID_CARTA_CANONICO": "ID_CARTA_CANONICO"},
            {"ID_CARTA_CANONICO": F.col("ID_CARTA")},
            ("FLG_ID_CARTA_MIGRADO", "Sim", "Nao"),
            driver_unique=True,
        ),
    ]
    return build_dim(cards.select(*sc.DIM[:9]), lookups).select(*sc.DIM)


def fact(prices: DataFrame, dim: DataFrame, hot: list | None = None) -> DataFrame:
    quotes = prices.select(
        "ID_CARTA",
        F.col("DT_INGESTAO").alias("DT_COTACAO"),
        *sc.PRICE_VALUES,
        F.col("ANO_INGESTAO").alias("ANO_COTACAO"),
        F.col("MES_INGESTAO").alias("MES_COTACAO"),
    )
    return build_fact(quotes, dim, "ID_CARTA", hot).select(*sc.FACT)


MART = MartSpec(
    dim_table="TB_DIM_CARTAS",
    fact_table="TB_FATO_MERCADO_CARTAS",
    key="ID_CARTA",
    quote_time="DT_INGESTAO",
    quote_year="ANO_INGESTAO",
    fact_time="DT_COTACAO",
    fact_partitions=("ANO_COTACAO", "MES_COTACAO"),
    assemble=fact,
    dim_columns=sc.DIM,
    fact_columns=sc.FACT,
    quote_columns=("ID_CARTA", "DT_INGESTAO", *sc.PRICE_VALUES),
    quote_partitions=("ANO_INGESTAO", "MES_INGESTAO"),
)


def fact_checks() -> list[Check]:
    categories = (
        "NME_CARTA NME_TIPO_CARTA NME_RARIDADE NME_CATEGORIA_COR COD_CORES NME_COLECAO NME_BLOCO"
    )
    # The checks' names.
    return [
        Check("fk_null_id_oracle", F.count_if(F.col("ID_ORACLE").isNull())),
        Check("null_residual_categorico", F.count_if(any_null(*categories.split()))),
        Check("valor_negativo_preco", F.count_if(any_negative(*sc.PRICE_VALUES))),
        Check("fk_colecao_nao_encontrada", F.count_if(F.col("NME_COLECAO") == sc.UNKNOWN), None),
        Check("cartas_com_id_migrado", F.count_if(F.col("FLG_ID_CARTA_MIGRADO") == "Sim"), None),
    ]


def join_checks() -> list[Check]:
    """On one row of counts: what the fact's inner join leaves out."""
    # The checks' names.
    return [
        Check("cartas_excluidas_sem_cotacao_de_preco", F.max("without_quote"), None),
        Check("precos_excluidos_sem_carta", F.max("without_card"), ORPHAN_QUOTE_LIMIT),
    ]
