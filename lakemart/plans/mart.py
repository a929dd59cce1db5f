"""Refresh of a current dimension and its incremental fact (Gold)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakemart.operators.contract import check_contract
from lakemart.operators.dimension import changed_ids, changed_prints, incremental_slice, member_prints
from lakemart.operators.keyed import check_keys
from lakemart.plans.counters import heavy_keys, newest
from lakemart.plans.counts import RowCount
from lakemart.plans.keyed_save import in_partitions, save_keyed
from lakemart.plans.lineage import scratch
from lakemart.plans.reconcile import differing_partitions, stored_prints
from lakemart.plans.store import TableStore, with_folder


@dataclass(frozen=True)
class MartSpec:
    """Names of a mart. ``quote_time`` and ``quote_year`` are columns of the quotes,
    ``fact_time`` the fact's name for the former; ``assemble`` joins quotes to the
    dimension, given the hot members or None, and projects the fact."""

    dim_table: str
    fact_table: str
    key: str
    quote_time: str
    quote_year: str | None
    fact_time: str
    fact_partitions: tuple[str, ...]
    assemble: Callable[[DataFrame, DataFrame, list | None], DataFrame]
    dim_columns: list[str] | None = None
    fact_columns: list[str] | None = None
    # What tells a member's quotes of one time apart, if anything does.
    keys: tuple[str, ...] = ()
    # Columns of the quotes that the fact takes over, and the quotes' names of the
    # fact's partitions; needed to find late quotes.
    quote_columns: tuple[str, ...] = ()
    quote_partitions: tuple[str, ...] = ()


def may_increment(rebuild: bool, fact_exists: bool, stored_dim: list[str] | None, fresh_dim: list[str]) -> bool:
    """Incremental only with both tables there and the same dimension columns in order."""
    return not rebuild and fact_exists and stored_dim is not None and stored_dim == fresh_dim


@dataclass(frozen=True)
class QuoteSource:
    """The stored table that the quotes are read from."""

    store: TableStore
    table: str


def refresh_mart(
    store: TableStore,
    spec: MartSpec,
    dim: DataFrame,
    quotes: DataFrame,
    rebuild: bool = False,
    source: QuoteSource | None = None,
) -> int:
    """Write the fact, then the dimension; returns the number of fact rows processed.

    A change of a member reaches its old quotes: ids whose recomputed row differs
    from the stored one are found before anything is replaced. The fact goes first:
    should it fail, the stored dimension still shows the same changes next time.

    New quotes are those after the fact's newest. With ``source``, the table that ``quotes``
    reads whole, they are those of partitions whose prints aren't the ones that the fact was
    made from: late quotes come in and withdrawn ones go, whatever their time, and only
    these partitions are made anew.
    """
    with scratch(store.spark) as cut:
        dim = cut(dim, f"dim-{spec.dim_table}")
        stored_dim = store.read_or_none(spec.dim_table)
        stored_columns = stored_dim.columns if stored_dim is not None else None
        increment = may_increment(rebuild, store.exists(spec.fact_table), stored_columns, dim.columns)
        prints = _source_prints(spec, source, cut) if source is not None else None
        made_from = store.read_or_none(_made_from(spec)) if prints is not None else None
        # Two narrow columns instead of the stored dimension, where a run has left them.
        members = cut(member_prints(dim, spec.key), "members")
        known = store.read_or_none(_members(spec))

        def changed_members() -> DataFrame:
            if known is None:
                return cut(changed_ids(dim, stored_dim, spec.key), "changed")
            return cut(changed_prints(members, known, spec.key), "changed")

        if increment and made_from is not None:
            changed = changed_members()
            processed = _refresh_differing(store, spec, dim, quotes, changed, prints, made_from)
        else:
            cutoff = newest(store, spec.fact_table, spec.fact_time) if increment else None
            if cutoff is not None:
                changed = changed_members()
                quotes = incremental_slice(
                    quotes, changed, spec.key, spec.quote_time, cutoff, spec.quote_year
                )
            # A rebuild looks for hot members in one column of the quotes. In an increment
            # that would repeat the slice, and both inputs of its join are shuffled for
            # it, so adaptive execution can split a hot member.
            hot = [] if cutoff is not None else None
            if hot is None and source is not None:
                hot = heavy_keys(source.store, source.table, spec.key)
            processed = _save_fact(store, spec, quotes, dim, hot, cutoff is not None)
        if prints is not None:
            # After the fact: a run that ends in between makes the same partitions once more.
            store.overwrite(prints, _made_from(spec))
        save_keyed(
            dim,
            store,
            spec.dim_table,
            keys=[spec.key],
            documented=spec.dim_columns,
            on_duplicate="abort",
            mode="overwrite",
        )
        # Last: prints that are older than the dimension only show more changes than there are.
        store.overwrite(members, _members(spec))
        return processed


def _members(spec: MartSpec) -> str:
    return f"{spec.dim_table}__members"


def _made_from(spec: MartSpec) -> str:
    return f"{spec.fact_table}__made_from"


def _source_prints(spec: MartSpec, source: QuoteSource, cut) -> DataFrame:
    """Prints of the quotes by the fact's partitions."""
    if len(spec.quote_partitions) != len(spec.fact_partitions):
        raise ValueError("the quotes' partitions have to be those of the fact")
    by = list(spec.quote_partitions)
    columns = [c for c in spec.quote_columns if c not in by]
    return cut(stored_prints(source.store, source.table, by, columns), "prints")


def _save_fact(store, spec, quotes, dim, hot, upsert: bool) -> int:
    processed = RowCount()
    save_keyed(
        processed.on(spec.assemble(quotes, dim, hot)),
        store,
        spec.fact_table,
        keys=[spec.key, spec.fact_time, *spec.keys],
        partition_by=spec.fact_partitions,
        documented=spec.fact_columns,
        on_duplicate="abort",
        mode="upsert" if upsert else "overwrite",
        key_decides_partition=True,
    )
    return processed.value


def _refresh_differing(store, spec, dim, quotes, changed, prints, made_from) -> int:
    """Differing partitions as a whole, and in the others the quotes of changed members."""
    by = list(spec.quote_partitions)
    differ = [tuple(row) for row in differing_partitions(prints, made_from, by).collect()]
    anew = in_partitions(differ, by)
    total = _save_fact(store, spec, quotes.filter(~anew).join(changed, spec.key, "left_semi"), dim, [], True)
    if not differ:
        return total
    processed = RowCount()
    fresh = processed.on(spec.assemble(quotes.filter(anew), dim, []))
    fact = store.read(spec.fact_table)
    check_contract(spec.fact_table, fact.schema, fresh.schema, spec.fact_columns)
    with scratch(store.spark) as cut:
        fresh = cut(fresh, "partitions")
        check_keys(fresh, [spec.key, spec.fact_time, *spec.keys], spec.fact_table)
        old = with_folder(fact.filter(in_partitions(differ, list(spec.fact_partitions))))
        touched = old.select(*spec.fact_partitions, "_folder").distinct().collect()
        store.replace_partitions(fresh, spec.fact_table, spec.fact_partitions, touched)
    return total + processed.value
