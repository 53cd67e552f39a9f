"""Provider dimension and the two fact tables joined to it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as k
from ..functions import columns as c
from ..operators.joins import broadcast_limit, estimated_bytes, hot_keys, lookup_join
from . import staging


def providers(staged: DataFrame) -> DataFrame:
    """Registry with a name to show and a label for the entity type."""
    return staged.drop("_loaded_at").select(
        "*",
        c.display_name("entity_type", "org_name", "first_name", "last_name", "npi").alias("display_name"),
        c.entity_label("entity_type").alias("entity_type_label"),
        F.current_timestamp().alias("_updated_at"),
    )


def dim_providers(provider: DataFrame) -> DataFrame:
    return provider.select(*k.DIM_COLUMNS)


def _registry(provider: DataFrame) -> DataFrame:
    """The few registry columns a join needs, prefixed so they cannot clash."""
    wanted = ("display_name", "city", "state", "primary_taxonomy_code", "entity_type_label")
    return provider.select("npi", *(F.col(x).alias(f"reg_{x}") for x in wanted))


def enrich_spending(staged: DataFrame, provider: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Registry values win; the claim's own values fill in where there is no match.

    ``sizes``: optional cheap frame with an ``npi`` column to find hot providers on.
    """
    return _spending(lookup_join(staged, _registry(provider), ["npi"], ["spending_id"], sizes=sizes))


def _spending(joined: DataFrame) -> DataFrame:
    merged = {
        "provider_name": c.first_known("reg_display_name", "provider_name"),
        "provider_city": c.first_known("reg_city", "provider_city"),
        "provider_state": c.first_known("reg_state", "provider_state"),
        "provider_taxonomy_or_specialty": c.first_known("reg_primary_taxonomy_code", "specialty"),
        "entity_type_label": F.col("reg_entity_type_label"),
    }
    return joined.withColumns(merged).select(*k.SPENDING_COLUMNS)


def enrich_utilization(staged: DataFrame, provider: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """City and state come from the registry only; an unmatched provider has none."""
    return _utilization(lookup_join(staged, _registry(provider), ["npi"], ["utilization_id"], sizes=sizes))


def _utilization(joined: DataFrame) -> DataFrame:
    merged = {
        "provider_name": c.first_known("reg_display_name", "provider_name"),
        "cms_specialty": F.col("specialty"),
        "primary_taxonomy_code": F.col("reg_primary_taxonomy_code"),
        "entity_type_label": F.col("reg_entity_type_label"),
        "provider_city": F.col("reg_city"),
        "provider_state": F.col("reg_state"),
    }
    return joined.withColumns(merged).select(*k.UTILIZATION_COLUMNS)


def spending(raw: DataFrame, provider: DataFrame, sizes: DataFrame | None = None, layout: bool = False) -> DataFrame:
    """Raw spending, staged and enriched; see :func:`_in_one_shuffle`."""
    return _in_one_shuffle(raw, provider, "prscrbr_npi", staging.stage_spending, _spending, sizes, layout)


def utilization(raw: DataFrame, provider: DataFrame, sizes: DataFrame | None = None, layout: bool = False) -> DataFrame:
    """Raw utilization, staged and enriched; see :func:`_in_one_shuffle`."""
    return _in_one_shuffle(raw, provider, "rndrng_npi", staging.stage_utilization, _utilization, sizes, layout)


def _in_one_shuffle(raw: DataFrame, provider: DataFrame, id_column: str, stage: Callable, merge: Callable,
                    sizes: DataFrame | None, layout: bool) -> DataFrame:
    """The newest row of each key with its registry values; the rows of a fact are shuffled once.

    One shuffle brings the rows of a provider together: in ranges of year and provider, as they are written, while the
    registry is broadcast; by provider, as the join needs them, beyond that. The newest rows, the join and, with ``layout``,
    the write then go on where the rows are. Providers that own more rows than an average shuffle partition (few,
    by construction, so their ids are collected) take a way of their own, on which copies of a key are dropped before the shuffle
    and the registry's few rows are broadcast, so that no task gets all rows of one. Where there is none, that way is not in the
    plan: its rows would be read, and joined to what they come from, a second time.

    ``sizes``: optional cheap frame with the ``npi`` column to find these providers on, and a column ``rows``
    if a row of it stands for several.
    """
    lookup = _registry(provider)
    near = estimated_bytes(lookup) <= broadcast_limit(lookup)

    def together(typed: DataFrame) -> DataFrame:
        return typed.repartitionByRange("year", "npi") if near else typed.repartition("npi")

    ids = raw.select(F.col(id_column).cast("string").alias("npi")) if sizes is None else sizes
    found = hot_keys(ids, ["npi"], weight="rows" if "rows" in ids.columns else None)
    hot = [row.npi for row in found.collect() if row.npi is not None]
    if not hot:
        return merge(stage(raw, together).join(lookup, "npi", "left"))
    own = F.coalesce(F.col(id_column).cast("string").isin(hot), F.lit(False))
    known = F.broadcast(lookup.filter(F.col("npi").isin(hot)))
    many = merge(stage(raw.filter(own)).join(known, "npi", "left"))
    if layout:
        many = many.repartitionByRange("year", "npi")
    return merge(stage(raw.filter(~own), together).join(lookup, "npi", "left")).unionByName(many)


def fct_provider_spending(enriched: DataFrame) -> DataFrame:
    return enriched.select(*k.SPENDING_COLUMNS)
