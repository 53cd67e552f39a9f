"""Rankings, pivots, measures and relations that read the marts and analytics tables.

Every ranking ends on a key, so rows that tie at the cut are chosen the same way each time.
All of them plan as a top-k per task followed by one merge of k rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators.joins import lookup_join, with_distinct
from ..operators.running import running_sums
from .marts import RATE, one_row


def top(df: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    """First ``n`` rows by ``by`` descending (nulls last), then ``ties`` ascending."""
    return df.orderBy(F.col(by).desc_nulls_last(), *(F.col(t).asc_nulls_last() for t in ties)).limit(n)


def _in_year(df: DataFrame, year: int | None) -> DataFrame:
    return df if year is None else df.filter(F.col("year") == year)


# Overviews ------------------------------------------------------------------------------
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact row count per table. A count reads no column, only the Parquet footers."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


overview = row_counts


def distinct_values(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    values = df.select(col).distinct()
    return (values if keep_null else values.filter(F.col(col).isNotNull())).orderBy(col)


def average_withhold(benchmark: DataFrame) -> DataFrame:
    """Plain mean over all benchmark rows, the unknown specialty included."""
    return benchmark.agg(c.exact_mean("avg_withhold_rate", 4).cast(RATE).alias("rate"))


def dashboard_kpis(
    dim: DataFrame, utilization: DataFrame, spending: DataFrame, benchmark: DataFrame
) -> DataFrame:
    """The four numbers of the start page. Counts of written tables come from their footers."""
    counts = {"providers": dim, "utilization_rows": utilization, "spending_rows": spending}
    frames = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in counts.items()]
    return one_row([*frames, average_withhold(benchmark).withColumnRenamed("rate", "avg_withhold")])


# Specialties and states -----------------------------------------------------------------
def benchmarks(benchmark: DataFrame, year: int, state: str | None = None, n: int = 15) -> DataFrame:
    """Highest benchmark rows of a year, optionally of one state."""
    rows = _in_year(benchmark, year)
    if state is not None:
        rows = rows.filter(F.col("state") == state)
    return top(rows, "avg_withhold_rate", n, "specialty", "state").select(
        "specialty", "state", "year", "provider_count", "total_services",
        "avg_withhold_rate", "median_withhold_rate",
    )


def top_specialties_unweighted(benchmark: DataFrame, n: int = 20) -> DataFrame:
    rows = benchmark.filter(c.known("specialty")).groupBy("specialty", "year").agg(
        F.sum("provider_count").alias("providers"),
        F.sum("service_line_count").alias("service_lines"),
        c.exact_mean("avg_withhold_rate", 4).cast(RATE).alias("avg_withhold_rate"),
        c.exact_mean("median_withhold_rate", 4).cast(RATE).alias("median_withhold_rate"),
    )
    return top(rows, "avg_withhold_rate", n, "specialty", "year")


def top_states_unweighted(benchmark: DataFrame, n: int = 15) -> DataFrame:
    rows = benchmark.filter(c.known("state")).groupBy("state", "year").agg(
        c.exact_mean("avg_withhold_rate", 4).cast(RATE).alias("avg_withhold_rate"),
        F.sum("provider_count").alias("providers"),
    )
    return top(rows, "avg_withhold_rate", n, "state", "year")


def state_year_pivot(ranked_states: DataFrame, years: Sequence[int]) -> DataFrame:
    """State x year grid of the ranked rows; naming the years saves a pass to find them."""
    return ranked_states.groupBy("state").pivot("year", list(years)).agg(F.first("avg_withhold_rate"))


def top_specialties(national: DataFrame, year: int, n: int = 15) -> DataFrame:
    return top(_in_year(national, year), "weighted_avg_withhold_rate", n, "specialty").select(
        "specialty", "weighted_avg_withhold_rate", "total_services", "provider_count"
    )


def top_states(states: DataFrame, year: int, n: int = 15) -> DataFrame:
    return top(_in_year(states, year), "weighted_avg_withhold_rate", n, "state").select(
        "state", "year", "weighted_avg_withhold_rate", "provider_count", "total_services"
    )


def _rate_pair(yoy: DataFrame) -> tuple[str, str]:
    return tuple(sorted(x for x in yoy.columns if x.startswith("withhold_rate_") and x[-4:].isdigit()))


def top_increases(yoy: DataFrame, n: int = 20) -> DataFrame:
    return top(yoy, "withhold_rate_change", n, "specialty").select(
        "specialty", *_rate_pair(yoy), "withhold_rate_change", "withhold_rate_pct_change",
        "service_volume_change",
    )


def year_pairs(yoy: DataFrame) -> DataFrame:
    """Both years' rates per specialty, with the upper limit of a square plot."""
    r0, r1 = _rate_pair(yoy)
    limit = yoy.agg(F.greatest(F.max(r0), F.max(r1))).scalar()
    return yoy.select("specialty", r0, r1).withColumn("axis_limit", limit)


# Drugs ----------------------------------------------------------------------------------
def top_drugs_from_fact(fact: DataFrame, n: int = 20) -> DataFrame:
    """Drug x year straight from the fact; rows that name no drug count as Unknown."""
    keys = ("drug", "year")
    named = fact.withColumn("drug", c.or_unknown(c.first_known("drug_name", "generic_name")))
    sums = named.groupBy(*keys).agg(
        F.sum("total_claim_count").alias("claims"),
        F.sum("total_drug_cost").alias("total_medicare_cost"),
    )
    rows = with_distinct(sums, named, keys, "npi", "prescriber_count")
    return top(rows, "total_medicare_cost", n, "drug", "year")


def top_drugs(drugs: DataFrame, year: int, n: int = 20) -> DataFrame:
    """Drugs of a year over their generics. ``prescriber_count`` adds the generics' counts,
    so someone who prescribed two generics of a drug counts twice; use
    :func:`top_drugs_from_fact` for distinct prescribers."""
    rows = _in_year(drugs, year).filter(F.col("drug_name").isNotNull()).groupBy("drug_name").agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_medicare_cost").alias("total_cost"),
        F.sum("prescriber_count").alias("prescriber_count"),
    )
    return top(rows, "total_cost", n, "drug_name")


def topn_totals(ranked: DataFrame) -> DataFrame:
    return ranked.agg(F.sum("total_cost").alias("combined_cost"), F.count(F.lit(1)).alias("drugs_shown"))


def top_drug_rows(drugs: DataFrame, year: int, n: int = 20) -> DataFrame:
    """Highest drug x generic rows of a year."""
    return top(_in_year(drugs, year), "total_medicare_cost", n, "drug_name", "generic_name").select(
        "drug_name", "generic_name", "year", "total_medicare_cost", "total_claims", "prescriber_count"
    )


def cost_by_year(drugs: DataFrame) -> DataFrame:
    return drugs.groupBy("year").agg(F.sum("total_medicare_cost").alias("total_medicare_cost"))


def pareto(drugs: DataFrame, year: int, n: int | None = None, slices: int | None = None) -> DataFrame:
    """Running cost and its share over all rows of a year, or over its ``n`` costliest ones.

    The running sum is built over ranges of the costs and inside each range, so that no task walks
    through all rows. Where the ranges are cut does not change the result.
    """
    rows = _in_year(drugs, year)
    if n is not None:
        rows = top(rows, "total_medicare_cost", n, "drug_name", "generic_name")
    rows = rows.select("drug_name", "generic_name", "total_medicare_cost", "total_claims", "prescriber_count")
    order = [F.col("total_medicare_cost").desc_nulls_last(), F.col("drug_name").asc(), F.col("generic_name").asc_nulls_last()]
    cost = "total_medicare_cost"
    added = running_sums(rows, order, {"cum_cost": cost}, slices=slices, totals={"_total": cost})
    return added.withColumn("cum_cost", F.col("cum_cost").cast("decimal(38,2)")).withColumn(
        "cum_pct", F.col("cum_cost").cast("double") / F.col("_total").cast("double")
    ).drop("_total")


def pareto_cutoff(ranked: DataFrame, share: float = 0.8) -> DataFrame:
    return ranked.agg(
        F.count_if(F.col("cum_pct") <= share).alias("drugs_to_share"), F.count(F.lit(1)).alias("drugs_shown")
    )


def top_share(drugs: DataFrame, n: int = 10) -> DataFrame:
    """Cost share of the ``n`` costliest drugs, all drugs tied with the last one included.

    The cut is the n-th cost, found by a top-k, so no global rank is needed.
    """
    by_drug = drugs.groupBy("drug_name").agg(F.sum("total_medicare_cost").alias("cost"))
    cut = by_drug.orderBy(F.col("cost").desc_nulls_last()).limit(n).agg(F.min("cost")).scalar()
    cost = F.col("cost").cast("double")
    return by_drug.agg(
        F.sum(F.when(F.col("cost") >= cut, F.col("cost"))).alias("top_cost"),
        F.sum("cost").alias("total_cost"),
    ).select(
        "top_cost", "total_cost",
        F.coalesce(F.col("top_cost").cast("double") / F.nullif(F.col("total_cost").cast("double"), F.lit(0.0)),
                   F.lit(0.0)).alias("top_share"),
    )


# Providers ------------------------------------------------------------------------------
def provider_mix(dim: DataFrame, n: int = 15) -> DataFrame:
    rows = (
        dim.filter(F.col("state").isNotNull())
        .groupBy("entity_type_label", "state")
        .agg(F.count(F.lit(1)).alias("provider_count"))
    )
    return top(rows, "provider_count", n, "entity_type_label", "state")


def band_counts(risk: DataFrame, year: int) -> DataFrame:
    return (
        _in_year(risk, year)
        .groupBy("withhold_risk_band")
        .agg(F.count(F.lit(1)).alias("providers"))
        .orderBy(F.col("providers").desc(), "withhold_risk_band")
    )


def band_distinct(risk: DataFrame, year: int) -> DataFrame:
    return (
        _in_year(risk, year)
        .groupBy("withhold_risk_band")
        .agg(F.count_distinct("npi").alias("providers"))
    )


def top_outliers(risk: DataFrame, year: int, n: int = 20, band: str = "High") -> DataFrame:
    rows = _in_year(risk, year).filter(F.col("withhold_risk_band") == band)
    return top(rows, "withhold_vs_median", n, "npi", "cms_specialty", "provider_state").select(
        "npi", "provider_name", "cms_specialty", "provider_state",
        "avg_withhold_rate", "specialty_median_withhold", "withhold_vs_median",
    )


def high_withhold_preview(
    utilization: DataFrame, benchmark: DataFrame, year: int, n: int = 20, min_lines: int = 5
) -> DataFrame:
    """Providers of a year against the median of **every** state of their specialty: one row
    per provider and state, as the report has it (``provider_risk`` is the corrected form).

    The rows rank by the provider's own rate, so the ``n`` best rows belong to the ``n``
    best providers that have a median; only those are joined to the states.
    """
    rated = _in_year(benchmark, year).filter(c.known("specialty"))
    medians = rated.select(
        F.col("specialty").alias("cms_specialty"), "year", F.col("median_withhold_rate").alias("specialty_median")
    )
    providers = provider_rates(utilization, year, min_lines)
    matched = providers.join(medians.select("cms_specialty", "year").distinct(), ["cms_specialty", "year"], "left_semi")
    order = ("npi", "cms_specialty", "provider_state")
    best = top(matched, "rate", n, *order)
    rows = top(best.join(medians, ["cms_specialty", "year"]), "rate", n, *order, "specialty_median")
    return rows.select(
        "npi", "cms_specialty", "provider_state", "year",
        F.round("rate", 4).cast(RATE).alias("avg_withhold_rate"),
        "specialty_median",
        F.when(F.col("rate") > F.col("specialty_median"), 1).otherwise(0).alias("high_withhold_flag"),
        "service_lines",
    )


def provider_rates(utilization: DataFrame, year: int, min_lines: int) -> DataFrame:
    """Unrounded provider rates of one year (a missing specialty is a group here)."""
    lines = _in_year(utilization.filter("implied_withhold_rate is not null"), year)
    return (
        lines.groupBy("npi", "cms_specialty", "provider_state", "year")
        .agg(
            c.exact_mean("implied_withhold_rate", 16).alias("rate"),
            F.count(F.lit(1)).alias("service_lines"),
        )
        .filter(F.col("service_lines") >= min_lines)
    )


# Measures -------------------------------------------------------------------------------
def _mean(col: str):
    return F.sum(col).cast("double") / F.nullif(F.count(col), F.lit(0))


def measures_national(national: DataFrame) -> DataFrame:
    return national.agg(
        _mean("weighted_avg_withhold_rate").alias("avg_withhold"),
        F.sum("total_services").alias("total_services"),
        F.sum("provider_count").alias("total_providers"),
    )


def measures_yoy(yoy: DataFrame) -> DataFrame:
    change = "withhold_rate_change"
    return yoy.agg(
        F.count_if(F.col(change) > 0).alias("specialties_worsening"),
        _mean(change).alias("avg_yoy_withhold_change"),
        F.max(change).alias("largest_yoy_increase"),
    )


def measures_risk(risk: DataFrame) -> DataFrame:
    high = F.count_if(F.col("withhold_risk_band") == "High")
    share = high.cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))
    return risk.agg(
        high.alias("high_risk_count"),
        F.coalesce(share, F.lit(0.0)).alias("high_risk_share"),
        _mean("withhold_vs_median").alias("avg_withhold_vs_median"),
    )


def measures_drug(drugs: DataFrame) -> DataFrame:
    return drugs.agg(
        F.sum("total_medicare_cost").alias("total_part_d_cost"), F.sum("total_claims").alias("total_claims")
    )


def measures_kpi(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        F.max("national_avg_withhold_rate").alias("national_avg_withhold"),
        F.max("provider_count").alias("total_providers_kpi"),
    )


# Relations between the report tables ------------------------------------------------------
def star_national_yoy(national: DataFrame, yoy: DataFrame, year: int) -> DataFrame:
    """One year of the national table with its change. The year filter makes it one to one."""
    return _in_year(national, year).join(yoy, "specialty", "left")


def star_risk(risk: DataFrame, dim: DataFrame, national: DataFrame) -> DataFrame:
    """Risk rows with the provider's registry entry and the specialty's national rates.
    National has a row per specialty and year, so both are join keys."""
    registry = dim.select("npi", "display_name", "entity_type_label", "city", "zip")
    rates = national.select(
        F.col("specialty").alias("cms_specialty"), "year", "weighted_avg_withhold_rate", "avg_median_withhold_rate"
    )
    return lookup_join(risk, registry, ["npi"], ["provider_risk_id"]).join(rates, ["cms_specialty", "year"], "left")
