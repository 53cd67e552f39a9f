"""Benchmark, KPI, national, state, year-over-year, drug and risk tables.

Every aggregate here is combined inside the map tasks before it is shuffled, so a
specialty, drug or provider that owns a third of the rows arrives as a few partial rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators.joins import with_distinct

RATE = "decimal(24,4)"


GROUP = ("specialty", "state", "year")


def rated_lines(utilization: DataFrame) -> DataFrame:
    """Lines that have a rate, with a missing specialty or state as a bucket of its own."""
    return utilization.filter(F.col("implied_withhold_rate").isNotNull()).withColumns(
        {"specialty": c.or_unknown("cms_specialty"), "state": c.or_unknown("provider_state")}
    )


def group_medians(lines: DataFrame) -> DataFrame:
    """Exact median rate per group, from a histogram.

    Rates have 4 decimals, so a group has few distinct ones however many lines it has. They
    are counted first, spread over all tasks by their value, and only the counts meet.
    """
    counts = lines.groupBy(*GROUP, "implied_withhold_rate").agg(F.count(F.lit(1)).alias("lines"))
    median = c.exact_median("implied_withhold_rate", F.col("lines"))
    return counts.groupBy(*GROUP).agg(c.tidy_double(median, 4).alias("median_withhold_rate"))


def specialty_benchmark(utilization: DataFrame, stored: bool = False) -> DataFrame:
    """Specialty x state x year benchmark over the lines that have a rate. With ``stored``, for a table that is cheap to read
    once more, the providers are counted apart from the sums, which then are not shuffled once for each of them.

    The medians are a branch of their own: next to a distinct count they would keep every
    provider's rates apart up to the last step, in an aggregate without code generation.
    """
    lines = rated_lines(utilization)
    providers = [] if stored else [F.count_distinct("npi").alias("provider_count")]
    sums = lines.groupBy(*GROUP).agg(
        *providers,
        F.count(F.lit(1)).alias("service_line_count"),
        F.sum("service_count").alias("total_services"),
        F.sum("unique_beneficiary_count").alias("total_beneficiaries"),
        c.exact_mean("avg_allowed_amount", 2, 2).alias("avg_allowed_amount"),
        c.exact_mean("avg_medicare_payment", 2, 2).alias("avg_medicare_payment"),
        c.exact_mean("implied_withhold_rate", 4).cast(RATE).alias("avg_withhold_rate"),
        F.max("implied_withhold_rate").alias("max_withhold_rate"),
    )
    if stored:
        sums = with_distinct(sums, lines, GROUP, "npi", "provider_count")
    medians = group_medians(lines).select(*(F.col(x).alias(f"m_{x}") for x in GROUP), "median_withhold_rate")
    same_group = reduce(and_, (F.col(x).eqNullSafe(F.col(f"m_{x}")) for x in GROUP))
    key = c.surrogate_key(GROUP, strict=["specialty", "state"])
    return sums.join(medians, same_group).select(
        key.alias("specialty_benchmark_id"), *GROUP,
        "provider_count", "service_line_count", "total_services", "total_beneficiaries",
        "avg_allowed_amount", "avg_medicare_payment",
        "avg_withhold_rate", "median_withhold_rate", "max_withhold_rate",
        F.current_timestamp().alias("_updated_at"),
    )


def drug_spending(fact: DataFrame) -> DataFrame:
    """Drug x generic x year totals; rows that name no drug at all are left out."""
    keys = ("drug_name", "generic_name", "year")
    named = fact.filter(F.col("drug_name").isNotNull() | F.col("generic_name").isNotNull())
    named = named.withColumn("drug_name", c.or_unknown(c.first_known("drug_name", "generic_name")))
    sums = named.groupBy(*keys).agg(
        F.sum("total_claim_count").alias("total_claims"),
        F.sum("total_day_supply").alias("total_day_supply"),
        F.sum("total_drug_cost").alias("total_medicare_cost"),
        c.exact_mean("total_drug_cost", 2, 2).alias("avg_cost_per_row"),
    )
    return with_distinct(sums, named, keys, "npi", "prescriber_count")


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Put one-row frames side by side without a cross join: stack them, take the maxima."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))


def kpi_overview(dim: DataFrame, benchmark: DataFrame, fact: DataFrame) -> DataFrame:
    """One row of headline numbers. The two rates are plain means over benchmark rows.

    The two distinct counts are separate scans of one column each: together in one
    aggregate they would triple the rows of the fact before the first combine.
    """
    known = benchmark.filter(c.known("specialty"))
    return one_row(
        [
            dim.agg(F.count(F.lit(1)).alias("provider_count")),
            benchmark.agg(F.count(F.lit(1)).alias("benchmark_row_count")),
            known.agg(
                c.exact_mean("avg_withhold_rate", 4).cast(RATE).alias("national_avg_withhold_rate"),
                c.exact_mean("median_withhold_rate", 4).cast(RATE).alias("national_median_withhold_rate"),
            ),
            fact.agg(
                F.sum("total_drug_cost").alias("total_part_d_cost"),
                F.count_distinct("npi").alias("part_d_prescriber_count"),
            ),
            fact.agg(F.count_distinct("drug_name").alias("distinct_drugs")),
        ]
    ).withColumn("_updated_at", F.current_timestamp())


def national_benchmark(benchmark: DataFrame) -> DataFrame:
    """Specialty x year, rates weighted by providers."""
    return benchmark.filter(c.known("specialty")).groupBy("specialty", "year").agg(
        F.sum("provider_count").alias("provider_count"),
        F.sum("service_line_count").alias("service_line_count"),
        F.sum("total_services").alias("total_services"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        c.weighted_mean("avg_withhold_rate", "provider_count").cast(RATE).alias("weighted_avg_withhold_rate"),
        c.exact_mean("median_withhold_rate", 4).cast(RATE).alias("avg_median_withhold_rate"),
        F.max("max_withhold_rate").alias("max_withhold_rate"),
    )


def state_benchmark(benchmark: DataFrame) -> DataFrame:
    """State x year, rates weighted by providers."""
    return benchmark.filter(c.known("state")).groupBy("state", "year").agg(
        F.count_distinct("specialty").alias("specialty_count"),
        F.sum("provider_count").alias("provider_count"),
        F.sum("total_services").alias("total_services"),
        c.weighted_mean("avg_withhold_rate", "provider_count").cast(RATE).alias("weighted_avg_withhold_rate"),
        c.exact_mean("median_withhold_rate", 4).cast(RATE).alias("avg_median_withhold_rate"),
    )


def year_over_year(national: DataFrame, first: int, second: int) -> DataFrame:
    """Change between two years for the specialties that have a rate in both."""

    def in_year(col: str, year: int):
        return F.max(F.when(F.col("year") == year, F.col(col)))

    r0, r1 = f"withhold_rate_{first}", f"withhold_rate_{second}"
    s0, s1 = f"total_services_{first}", f"total_services_{second}"
    both = (
        national.filter(F.col("year").isin(first, second))
        .groupBy("specialty")
        .agg(
            in_year("weighted_avg_withhold_rate", first).alias(r0),
            in_year("weighted_avg_withhold_rate", second).alias(r1),
            in_year("total_services", first).alias(s0),
            in_year("total_services", second).alias(s1),
        )
        .filter(F.col(r0).isNotNull() & F.col(r1).isNotNull())
    )
    change = F.col(r1) - F.col(r0)
    return both.select(
        "specialty", r0, r1,
        change.cast(RATE).alias("withhold_rate_change"),
        F.round(change / F.nullif(F.col(r0), F.lit(0).cast(RATE)), 4).cast(RATE).alias("withhold_rate_pct_change"),
        s0, s1,
        (F.col(s1) - F.col(s0)).alias("service_volume_change"),
    )


def provider_year(utilization: DataFrame, min_lines: int = 5, year: int | None = None) -> DataFrame:
    """Provider x specialty x state x year with at least ``min_lines`` rated lines.

    The name is a grouping column of the first step, so that step stays a hash aggregate;
    a maximum over text would sort all the lines instead.
    """
    keys = ["npi", "cms_specialty", "provider_state", "year"]
    lines = utilization.filter("implied_withhold_rate is not null and cms_specialty is not null")
    if year is not None:
        lines = lines.filter(F.col("year") == year)
    by_name = lines.groupBy(*keys, "provider_name").agg(
        F.sum("implied_withhold_rate").alias("rate_sum"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("service_count").alias("services"),
        F.sum("avg_medicare_payment").alias("paid_sum"),
        F.count("avg_medicare_payment").alias("paid_lines"),
    )
    return (
        by_name.groupBy(*keys)
        .agg(
            F.max("provider_name").alias("provider_name"),
            c.exact_ratio(F.sum("rate_sum"), F.sum("lines"), 4, 4).cast(RATE).alias("avg_withhold_rate"),
            F.sum("lines").alias("service_line_count"),
            F.sum("services").cast("decimal(28,4)").alias("total_services"),
            c.exact_ratio(F.sum("paid_sum"), F.sum("paid_lines"), 2, 2).alias("avg_medicare_payment"),
        )
        .filter(F.col("service_line_count") >= min_lines)
    )


def specialty_medians(benchmark: DataFrame) -> DataFrame:
    """National median per specialty and year: state medians weighted by providers."""
    return (
        benchmark.filter(c.known("specialty"))
        .groupBy(F.col("specialty").alias("cms_specialty"), "year")
        .agg(
            c.weighted_mean("median_withhold_rate", "provider_count").cast(RATE)
            .alias("specialty_median_withhold")
        )
    )


def risk_band(rate: str, median: str):
    """A missing side compares as neither above nor below."""
    return (
        F.when(F.col(rate) > F.col(median), "High")
        .when(F.col(rate) < F.col(median), "Low")
        .otherwise("At Median")
    )


def provider_risk(utilization: DataFrame, benchmark: DataFrame, min_lines: int = 5) -> DataFrame:
    """Each provider-year against the median of its specialty.

    The medians are one row per specialty and year. They are not hinted: read from a
    written benchmark table their file size lets Catalyst broadcast them, and otherwise
    adaptive execution does so once it has measured them.
    """
    rated = provider_year(utilization, min_lines)
    joined = rated.join(specialty_medians(benchmark), ["cms_specialty", "year"])
    key = c.surrogate_key(["npi", "cms_specialty", "provider_state", "year"], strict=["npi"])
    gap = F.col("avg_withhold_rate") - F.col("specialty_median_withhold")
    return joined.select(
        key.alias("provider_risk_id"),
        "npi", "provider_name", "cms_specialty", "provider_state", "year",
        "avg_withhold_rate", "specialty_median_withhold",
        gap.cast(RATE).alias("withhold_vs_median"),
        risk_band("avg_withhold_rate", "specialty_median_withhold").alias("withhold_risk_band"),
        "service_line_count", "total_services", "avg_medicare_payment",
        F.current_timestamp().alias("_updated_at"),
    )
