"""The layer jobs of the card market."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.domain.cards import gold, silver, stage
from lakemart.domain.cards import schemas as sc
from lakemart.functions.dates import release_cutoff
from lakemart.operators.increment import newer_than, window_members
from lakemart.operators.quality import enforce, run_checks
from lakemart.plans.bronze import load_new_snapshots
from lakemart.plans.counters import check_table, heavy_keys, newest
from lakemart.plans.keyed_save import save_keyed
from lakemart.plans.landing import land_snapshot
from lakemart.plans.lineage import scratch
from lakemart.plans.mart import QuoteSource, refresh_mart
from lakemart.plans.refcounts import reference_counts, unmatched_counts
from lakemart.plans.runlog import audit_run, run_logged, utc_now
from lakemart.plans.store import TableStore

FEEDS = {
    "cards": stage.cards,
    "sets": stage.sets,
    "card_prices": stage.card_prices,
    "rulings": stage.rulings,
    "migrations": stage.migrations,
}


@dataclass(frozen=True)
class KeyedTable:
    feed: str
    transform: Callable[[DataFrame, dt.date], DataFrame]
    keys: tuple[str, ...]
    order_by: str | None
    partition_by: tuple[str, str]
    columns: list[str]
    key_decides_partition: bool = False


# The tables' names, keys and partitions.
TABLES = {
    "TB_FATO_CARTAS": KeyedTable(
        "cards", silver.cards, ("ID_CARTA",), "DT_INGESTAO", ("ANO_INGESTAO", "MES_INGESTAO"), sc.CARDS
    ),
    "TB_DIM_COLECOES": KeyedTable(
        "sets", silver.sets, ("COD_COLECAO",), "DT_INGESTAO", ("ANO_LANCAMENTO", "MES_LANCAMENTO"), sc.SETS
    ),
    "TB_FATO_PRECOS_CARTAS": KeyedTable(
        "card_prices", silver.prices, ("ID_CARTA", "DT_INGESTAO"), None,
        ("ANO_INGESTAO", "MES_INGESTAO"), sc.PRICES, key_decides_partition=True,
    ),
    "TB_FATO_ESCLARECIMENTOS_CARTAS": KeyedTable(
        "rulings", silver.rulings, ("ID_ESCLARECIMENTO",), "DT_INGESTAO",
        ("ANO_PUBLICACAO", "MES_PUBLICACAO"), sc.RULINGS, key_decides_partition=True,
    ),
    "TB_MOV_MIGRACOES_CARTAS": KeyedTable(
        "migrations", silver.migrations, ("ID_MIGRACAO",), "DT_INGESTAO",
        ("ANO_EXECUCAO", "MES_EXECUCAO"), sc.MIGRATIONS,
    ),
}


def run_stage(
    raw: DataFrame,
    feed: str,
    ledger: TableStore,
    stage_root: str,
    run_ts: dt.datetime,
    years_back: int = 5,
    raw_sets: DataFrame | None = None,
):
    """Flatten one feed and land it; returns (DataFrame, run row).

    Cards are kept when their set is in the release window (``raw_sets``), prices
    and sets by their own release date; rulings and migrations are kept whole.
    """
    cutoff = release_cutoff(run_ts.date(), years_back)
    if feed == "cards":
        if raw_sets is None:
            raise ValueError("cards are kept by the release of their set: raw_sets is needed")
        recent = raw_sets.filter(F.col("released_at") >= cutoff.isoformat())
        raw = window_members(raw, "set", recent, "code")
    dated = feed in ("sets", "card_prices")

    def job(run: dict):
        if feed == "sets":
            run["rejected_records"] = stage.unparsed_sets(raw)
        return land_snapshot(
            FEEDS[feed](raw),
            stage_root,
            feed,
            run_ts,
            date_column="releaseDate" if dated else None,
            cutoff=cutoff if dated else None,
            required=sc.MANDATORY[feed],
            default_source=sc.SOURCE,
            run=run,
        )

    params = {"years_back": years_back}
    return run_logged(ledger, feed, job, run_ts, params, source=sc.SOURCE, empty_fails=True)


def run_bronze(
    bronze: TableStore, stage_root: str, feed: str, load_ts: dt.datetime, allow_break: bool = False
):
    columns = sc.bronze_columns(feed)
    return load_new_snapshots(bronze, stage_root, feed, load_ts, columns, allow_break)


def run_silver(
    bronze: TableStore, silver_store: TableStore, table: str, as_of: dt.date, allow_break: bool = False
) -> None:
    """Clean and upsert the Bronze rows the table has not seen."""
    spec = TABLES[table]
    stored = silver_store.read_or_none(table)
    bound = newest(silver_store, table, "DT_INGESTAO_BRONZE") if stored is not None else None
    fresh = newer_than(bronze.read(spec.feed), "bronze_ingestion_timestamp", bound)
    df = spec.transform(fresh, as_of)
    with scratch(silver_store.spark) as cut:
        paths = None
        if spec.feed == "migrations":
            known = silver_store.read_or_none(f"{table}__walks")
            df, paths = silver.with_canonical(df, stored, cut, known)
        save_keyed(
            df,
            silver_store,
            table,
            spec.keys,
            spec.order_by,
            spec.partition_by,
            documented=spec.columns,
            allow_break=allow_break,
            key_decides_partition=spec.key_decides_partition,
        )
        if paths is not None:
            # After the events: walks of an earlier state are brought up to date next time.
            silver_store.overwrite(paths, f"{table}__walks")


def run_gold(silver_store: TableStore, gold_store: TableStore, rebuild: bool = False, clock=utc_now):
    """Checks, dimension, fact, checks; one audit row whatever happens."""
    with audit_run(gold_store, gold.MART.fact_table, clock) as audit:
        cards, sets, prices, rulings, migrations = (silver_store.read(t) for t in TABLES)
        audit.read = _count_rows(cards, sets, prices, rulings, migrations)
        audit.results |= enforce(run_checks(_unmatched(silver_store), gold.join_checks()), "pré-join")
        hot = [heavy_keys(silver_store, "TB_FATO_CARTAS", key) for key in ("COD_COLECAO", "ID_ORACLE")]
        dim = gold.dimension(cards, sets, rulings, migrations, *hot)
        source = QuoteSource(silver_store, "TB_FATO_PRECOS_CARTAS")
        with audit.saving():
            audit.processed = refresh_mart(gold_store, gold.MART, dim, prices, rebuild, source)
        report = check_table(gold_store, gold.MART.fact_table, gold.fact_checks())
        audit.results |= enforce(report, gold.MART.fact_table)
    return audit


def _count_rows(*frames: DataFrame) -> int:
    """Rows of all inputs in one job that reads no columns."""
    return reduce(DataFrame.union, [f.select(F.lit(1)) for f in frames]).count()


def _unmatched(silver_store: TableStore) -> DataFrame:
    """One row: cards without a quote, quoted ids without a card, from counts kept per id."""
    cards, prices = (
        reference_counts(silver_store, name, "ID_CARTA") for name in ("TB_FATO_CARTAS", "TB_FATO_PRECOS_CARTAS")
    )
    return unmatched_counts(cards, prices).withColumnsRenamed(
        {"left_only": "without_quote", "right_only": "without_card"}
    )
