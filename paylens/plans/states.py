"""Benchmark, drug and headline tables kept by year, so that a new or changed year is built from its own rows.

What a table needs of a year is a state: finished groups, as every group lies in one year; the sum
of its costs; the ids seen, as bitmaps of 32,768 neighbouring numbers, and the names seen. States of different years merge:
groups are put side by side, sums are added, bitmaps are joined bit by bit, names are made distinct. Each
state is a versioned table (:mod:`..sources.versions`), in which a year's rows are replaced at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c
from ..sources import versions
from ..sources.files import SOURCE
from . import marts

PLAIN = r"^[1-9]\d{0,17}$"  # ids that are told apart as numbers


def benchmark_state(utilization: DataFrame) -> DataFrame:
    return marts.specialty_benchmark(utilization, stored=True).drop("_updated_at")


def drug_state(fact: DataFrame) -> DataFrame:
    return marts.drug_spending(fact)


def cost_state(fact: DataFrame) -> DataFrame:
    return fact.groupBy("year").agg(F.sum("total_drug_cost").alias("cost"))


def id_state(fact: DataFrame) -> DataFrame:
    """A row for every run of 32,768 numbers with an id in it, and one for every id that is no plain number."""
    seen = fact.filter(F.col("npi").isNotNull()).select("year", "npi").distinct()
    number = F.when(F.col("npi").rlike(PLAIN), F.col("npi").cast("long"))
    numbers = seen.withColumn("number", number).filter("number is not null").groupBy(
        "year", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    return numbers.unionByName(seen.filter(number.isNull()).withColumnRenamed("npi", "text"), allowMissingColumns=True)


def name_state(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("drug_name").isNotNull()).select("year", "drug_name").distinct()


UTILIZATION: dict[str, Callable[[DataFrame], DataFrame]] = {"benchmark": benchmark_state}
FACT: dict[str, Callable[[DataFrame], DataFrame]] = {"drugs": drug_state, "costs": cost_state, "ids": id_state, "names": name_state}


class YearStates:
    """The states under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def put(self, years: Sequence[int], utilization: DataFrame, fact: DataFrame) -> dict[str, int]:
        """Build the states of these years, from their rows alone, in place of what there was of them. Of
        other years nothing is read or changed. Returns the rows of each state.

        The states do not read each other, so they are written at the same time: the tail of one leaves
        executors free for the next."""
        names = {f"year={y}": "" for y in years}  # a year without rows ends its old ones too

        def write(name: str, make: Callable[[DataFrame], DataFrame], rows: DataFrame) -> int:
            state = make(rows.filter(F.col("year").isin(*years)))
            state = state.withColumn(SOURCE, F.concat(F.lit("year="), F.col("year").cast("string")))
            return versions.publish(state, f"{self.root}/{name}", versions.FILE, signatures=names)

        jobs = [(name, make, rows) for states, rows in ((UTILIZATION, utilization), (FACT, fact)) for name, make in states.items()]
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            return {job[0]: rows for job, rows in zip(jobs, pool.map(lambda job: write(*job), jobs))}

    def state(self, name: str) -> DataFrame:
        rows = versions.read(self.spark, f"{self.root}/{name}").drop(SOURCE)
        return rows.withColumn("year", F.col("year").cast("int"))

    def benchmark(self) -> DataFrame:
        return self.state("benchmark").withColumn("_updated_at", F.current_timestamp())

    def drugs(self) -> DataFrame:
        return self.state("drugs")

    def kpi(self, dim: DataFrame) -> DataFrame:
        """The headline row. No fact is read."""
        benchmark, ids = self.state("benchmark"), self.state("ids")
        known = benchmark.filter(c.known("specialty"))
        joined = ids.filter("bits is not null").groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("ids"))
        others = ids.filter("bits is null").select("text").distinct().agg(F.count(F.lit(1)).alias("ids"))
        return marts.one_row([
            dim.agg(F.count(F.lit(1)).alias("provider_count")),
            benchmark.agg(F.count(F.lit(1)).alias("benchmark_row_count")),
            known.agg(
                c.exact_mean("avg_withhold_rate", 4).cast(marts.RATE).alias("national_avg_withhold_rate"),
                c.exact_mean("median_withhold_rate", 4).cast(marts.RATE).alias("national_median_withhold_rate")),
            self.state("costs").agg(F.sum("cost").cast("decimal(28,2)").alias("total_part_d_cost")),
            joined.select("ids").unionByName(others).agg(F.sum("ids").alias("part_d_prescriber_count")),
            self.state("names").agg(F.count_distinct("drug_name").alias("distinct_drugs")),
        ]).withColumn("_updated_at", F.current_timestamp())
