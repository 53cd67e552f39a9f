"""The end-to-end job: every layer, or chosen layers, from the raw tables."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import contracts as k
from ..sources.ledger import record_run
from ..sources.raw import now
from . import enrich, lookup, marts, staging

# Written by year, so that a read of one year opens that year's folder only, and cut into ranges
# of providers, so that a provider's rows of a year lie in one file, or few neighbouring ones, and
# the others are skipped by their statistics. The files are as many as the shuffle's partitions,
# which adaptive execution sizes by the data. The facts come in that order from their only shuffle (by
# provider alone where the registry is too large to broadcast: Bloom filters then tell the files).
LAID_OUT = {"int_utilization_enriched", "int_spending_enriched"}
BY_YEAR = {"int_utilization_enriched", "int_spending_enriched", "anl_provider_withhold_risk"}
# Not split by year, but read by provider as well.
BY_PROVIDER = {"dim_providers"}
# A provider's rows are looked up by id: besides the ranges, Bloom filters tell row groups without it.
POINT_READS = {"parquet.bloom.filter.enabled#npi": "true"}
# Version 2 pages keep the lengths of texts apart: ids, which are half of a fact, take a tenth less.
PACKED = {"compression": "zstd", "parquet.writer.version": "v2"}

# Tables of a layer that do not read each other are written at the same time: the tail of
# one job leaves executors free for the next.
WAVES = {
    "intermediate": (["int_providers"], ["int_utilization_enriched", "int_spending_enriched"]),
    "marts": (["dim_providers", "fct_utilization_by_specialty"],),
    "analytics": (
        ["anl_withhold_national", "anl_withhold_by_state", "anl_drug_spending", "anl_provider_withhold_risk",
         "anl_kpi_overview"],
        ["anl_withhold_yoy"],
    ),
}


class Warehouse:
    """Tables of all layers under one folder.

    Staging stays lazy: each staging frame has one consumer. The enriched facts are written
    once, because several marts read them, and each of those then scans only its columns.
    """

    def __init__(self, spark: SparkSession, root: str, raw: Mapping[str, DataFrame] | None = None,
                 years: tuple[int, int] = (2023, 2024), sizes: Mapping[str, DataFrame] | None = None):
        """``sizes``: of raw facts, cheap frames to find hot providers on; else their id columns are read."""
        self.spark, self.root, self.raw, self.years, self.sizes = spark, root.rstrip("/"), raw or {}, years, sizes or {}

    def table(self, name: str) -> DataFrame:
        if name in k.CONTRACTS["staging"]:
            return self.plan(name)
        if name == "fct_provider_spending":  # the same columns as the enriched spending
            return enrich.fct_provider_spending(self.table("int_spending_enriched"))
        return self.spark.read.parquet(f"{self.root}/{name}")

    def tables(self, layers: Sequence[str] = k.LAYERS) -> dict[str, DataFrame]:
        return {name: self.table(name) for layer in layers for name in k.CONTRACTS[layer]}

    def plan(self, name: str) -> DataFrame:
        """The frame that makes a table, from the tables it needs."""
        need = self.table
        plans = {
            "stg_cms_part_d_spending": lambda: staging.stage_spending(self.raw["cms_part_d_spending"]),
            "stg_cms_provider_utilization": lambda: staging.stage_utilization(self.raw["cms_provider_utilization"]),
            "stg_nppes_providers": lambda: staging.stage_providers(self.raw["nppes_providers"]),
            "int_providers": lambda: enrich.providers(need("stg_nppes_providers")),
            "int_utilization_enriched": lambda: enrich.utilization(
                self.raw["cms_provider_utilization"], need("int_providers"), self.sizes.get("cms_provider_utilization"), layout=True),
            "int_spending_enriched": lambda: enrich.spending(
                self.raw["cms_part_d_spending"], need("int_providers"), self.sizes.get("cms_part_d_spending"), layout=True),
            "dim_providers": lambda: enrich.dim_providers(need("int_providers")),
            "fct_utilization_by_specialty": lambda: marts.specialty_benchmark(need("int_utilization_enriched"), stored=True),
            "anl_kpi_overview": lambda: marts.kpi_overview(
                need("dim_providers"), need("fct_utilization_by_specialty"), need("fct_provider_spending")
            ),
            "anl_withhold_national": lambda: marts.national_benchmark(need("fct_utilization_by_specialty")),
            "anl_withhold_by_state": lambda: marts.state_benchmark(need("fct_utilization_by_specialty")),
            "anl_withhold_yoy": lambda: marts.year_over_year(need("anl_withhold_national"), *self.years),
            "anl_drug_spending": lambda: marts.drug_spending(need("fct_provider_spending")),
            "anl_provider_withhold_risk": lambda: marts.provider_risk(
                need("int_utilization_enriched"), need("fct_utilization_by_specialty")
            ),
        }
        return plans[name]()

    @property
    def name_index(self) -> str:
        """Where the postings of the registry's names lie."""
        return f"{self.root}/dim_providers_names"

    def write(self, name: str) -> int:
        """Build one table and return its rows, counted by the write itself."""
        seen = Observation(name)
        df = self.plan(name).observe(seen, F.count(F.lit(1)).alias("rows"))
        if name in BY_YEAR:
            laid = df if name in LAID_OUT else staging.dealt(df, lambda x: x.repartitionByRange("year", "npi"))
            writer = laid.sortWithinPartitions("year", "npi").write.partitionBy("year").options(**POINT_READS)
        elif name in BY_PROVIDER:
            writer = df.repartitionByRange("npi").sortWithinPartitions("npi").write.options(**POINT_READS)
        else:
            writer = df.write
        writer.options(**PACKED).mode("overwrite").parquet(f"{self.root}/{name}")
        return seen.get["rows"]

    def write_layer(self, layer: str) -> dict[str, int]:
        rows: dict[str, int] = {}
        with ThreadPoolExecutor(max_workers=8) as pool:
            for wave in WAVES[layer]:
                rows.update(zip(wave, pool.map(self.write, wave)))
        if "dim_providers" in rows:
            lookup.write_name_index(self.table("dim_providers"), self.name_index)
        return rows


def build(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, layers: Sequence[str] = k.LAYERS,
    years: tuple[int, int] = (2023, 2024), ledger: str | None = None, triggered_by: str = "manual",
    sizes: Mapping[str, DataFrame] | None = None,
) -> Warehouse:
    """Write the chosen layers in order; staging is lazy and cannot be chosen alone. With
    ``ledger`` the run, its steps, their times and their row counts are recorded; a failing step
    is recorded and raised."""
    if unknown := set(layers) - set(k.LAYERS):
        raise ValueError(f"no such layers: {sorted(unknown)}")
    if not set(layers) - {"staging"}:
        raise ValueError("staging is never written: choose a layer that reads it")
    house = Warehouse(spark, root, raw, years, sizes)
    run = {"pipeline_name": "payment_analytics", "triggered_by": triggered_by, "steps": [], "started_at": now()}

    def record(status: str, error: str | None = None) -> None:
        if ledger:
            ended = None if status == "running" else now()
            state = {**run, "status": status, "error_message": error, "finished_at": ended}
            run["run_id"] = record_run(spark, ledger, state)

    record("running")
    try:
        for layer in (x for x in k.LAYERS if x in layers and x != "staging"):
            start = time.time()
            rows = house.write_layer(layer)
            run["steps"].append(
                {
                    "name": layer, "status": "success", "duration_sec": round(time.time() - start, 2),
                    "detail": ", ".join(f"{name}={n}" for name, n in rows.items()),
                }
            )
    except Exception as error:
        run["steps"].append({"name": "error", "status": "failed", "duration_sec": 0.0, "detail": str(error)[:500]})
        record("failed", str(error))
        raise
    record("success")
    return house
