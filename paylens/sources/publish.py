"""Sinks: CSV export and capped publishing of the built tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as k
from ..operators.sampling import sample_n, stratified_cap
from ..plans.reports import row_counts

ROW_KEYS = {
    "anl_provider_withhold_risk": ["provider_risk_id"],
    "dim_providers": ["npi"],
    "int_utilization_enriched": ["utilization_id"],
}


def thin_for_export(risk: DataFrame, strata: Mapping[str, int] = k.EXPORT_STRATA) -> DataFrame:
    """At most so many rows of each named stratum of the risk table; other strata are left out."""
    return stratified_cap(risk, "withhold_risk_band", strata, ["provider_risk_id"])


def export_csv(
    tables: Mapping[str, DataFrame], folder: str, names: Sequence[str] = k.EXPORT_TABLES, strata: Mapping[str, int] | None = None
) -> list[str]:
    """One folder of CSV files with headers per table; the executors write their parts. All rows
    are written; only with ``strata`` is the risk table thinned."""
    written = []
    for name in names:
        df = tables[name]
        if strata and name == "anl_provider_withhold_risk":
            df = thin_for_export(df, strata)
        target = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(target)
        written.append(target)
    return written


def capped(tables: Mapping[str, DataFrame], caps: Mapping[str, int]) -> dict[str, DataFrame]:
    """Tables cut to their caps. The rows kept are a repeatable choice by key hash."""
    return {
        name: sample_n(df, caps[name], ROW_KEYS[name]) if name in caps else df for name, df in tables.items()
    }


def publish(
    tables: Mapping[str, DataFrame], folder: str, caps: Mapping[str, int] | None = None,
    dry_run: bool = False, url: str | None = None,
) -> DataFrame:
    """Write the tables (Parquet, or a database with ``url``) and return the rows per table.
    Everything is published; only the tables named in ``caps`` (such as
    :data:`contracts.PUBLISH_CAPS`) are cut. ``dry_run`` only counts."""
    caps = caps or {}
    if not dry_run:
        for name, df in capped(tables, caps).items():
            writer = df.write.mode("overwrite")
            writer.jdbc(url, name) if url else writer.parquet(f"{folder.rstrip('/')}/{name}")
    return publish_counts(tables, caps)


def publish_counts(tables: Mapping[str, DataFrame], caps: Mapping[str, int]) -> DataFrame:
    counts = row_counts(tables)
    cap = F.lit(None).cast("bigint")
    for name, n in caps.items():
        cap = F.when(F.col("table_name") == name, F.lit(n).cast("bigint")).otherwise(cap)
    return counts.select(
        "table_name", F.col("row_count").alias("source_rows"), F.least("row_count", cap).alias("published_rows")
    )
