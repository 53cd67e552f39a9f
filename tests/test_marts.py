from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from paylens.plans import lookup, marts, reports

UTIL = ("npi string, provider_name string, cms_specialty string, provider_state string, service_count decimal(18,4), "
        "unique_beneficiary_count int, avg_allowed_amount decimal(18,2), avg_medicare_payment decimal(18,2), "
        "implied_withhold_rate decimal(24,4), year int")
BENCH = ("specialty string, state string, year int, provider_count bigint, service_line_count bigint, "
         "total_services decimal(28,4), total_beneficiaries bigint, avg_withhold_rate decimal(24,4), "
         "median_withhold_rate decimal(24,4), max_withhold_rate decimal(24,4)")
DRUGS = "drug_name string, generic_name string, year int, prescriber_count bigint, total_claims bigint, total_medicare_cost decimal(28,2)"


def line(npi="1", spec="S", state="TX", rate="0.2", year=2024, name="N"):
    rate = None if rate is None else D(rate)
    return (npi, name, spec, state, D(1), 1, D(100), D(80), rate, year)


def bench(spec="S", state="TX", year=2024, w=1, rate="0.2", median="0.2"):
    return (spec, state, year, w, 1, D(1), 1, D(rate), None if median is None else D(median), D("0.5"))


def test_benchmark(spark):
    df = spark.createDataFrame(
        [line("1", rate="0.1"), line("1", rate="0.2"), line("2", rate="0.4"), line("3", None, None), line("4", rate=None),
         line("5", "S", "TX", "0.9", None)], UTIL)
    got = {(r.specialty, r.state, r.year): r for r in marts.specialty_benchmark(df).collect()}
    assert set(got) == {("S", "TX", 2024), ("Unknown", "Unknown", 2024), ("S", "TX", None)}
    row = got["S", "TX", 2024]
    assert (row.provider_count, row.service_line_count) == (2, 3)
    assert (row.avg_withhold_rate, row.median_withhold_rate, row.max_withhold_rate) == (D("0.2333"), D("0.2000"), D("0.4000"))


def test_provider_year_needs_five_lines(spark):
    df = spark.createDataFrame([line("1")] * 4 + [line("2", name=n) for n in "abcde"] + [line("3", None)] * 5, UTIL)
    got = marts.provider_year(df).collect()
    assert [(r.npi, r.provider_name, r.service_line_count) for r in got] == [("2", "e", 5)]


def test_risk_bands(spark):
    df = spark.createDataFrame(
        [line("hi", rate="0.3")] * 5 + [line("lo", rate="0.1")] * 5 + [line("eq")] * 5 + [line("no", "T")] * 5
        + [line("un", "Unknown")] * 5, UTIL)
    b = spark.createDataFrame([bench(w=3, median="0.1"), bench(state="CA", w=1, median="0.5"), bench("T", w=0, median="0.2")], BENCH)
    got = {r.npi: r.withhold_risk_band for r in marts.provider_risk(df, b).collect()}
    assert got == {"hi": "High", "lo": "Low", "eq": "At Median", "no": "At Median"}


def test_year_over_year(spark):
    rows = [("A", 2023, D("0.1")), ("A", 2024, D("0.15")), ("B", 2023, D("0.1")), ("Z", 2023, D(0)), ("Z", 2024, D("0.1")),
            ("A", 2022, D("0.9"))]
    df = spark.createDataFrame(rows, "specialty string, year int, weighted_avg_withhold_rate decimal(24,4)")
    df = df.withColumn("total_services", F.lit(D(10)).cast("decimal(38,4)"))
    got = {r.specialty: r for r in marts.year_over_year(df, 2023, 2024).collect()}
    assert set(got) == {"A", "Z"}
    assert got["A"].withhold_rate_pct_change == D("0.5000") and got["Z"].withhold_rate_pct_change is None


def test_empty_inputs(spark):
    util, b = spark.createDataFrame([], UTIL), spark.createDataFrame([], BENCH)
    drugs = spark.createDataFrame([], DRUGS)
    fact = spark.createDataFrame([], "npi string, drug_name string, generic_name string, year int, total_claim_count int, "
                                 "total_day_supply int, total_drug_cost decimal(18,2)")
    for df in (marts.specialty_benchmark(util), marts.provider_risk(util, b), marts.national_benchmark(b),
               marts.state_benchmark(b), marts.drug_spending(fact), reports.pareto(drugs, 2024)):
        assert df.count() == 0
    kpi = marts.kpi_overview(fact.select("npi"), b, fact).first()
    assert (kpi.provider_count, kpi.benchmark_row_count, kpi.national_avg_withhold_rate, kpi.distinct_drugs) == (0, 0, None, 0)
    assert reports.top_share(drugs).first().top_share == 0.0
    assert reports.measures_risk(marts.provider_risk(util, b)).first().high_risk_share == 0.0


def test_drug_names(spark):
    rows = [("1", "B", "G"), ("1", None, "G"), ("2", None, None), ("2", "B", "G")]
    fact = spark.createDataFrame([(*r, 2024, 1, 1, D("1.00")) for r in rows],
                                 "npi string, drug_name string, generic_name string, year int, total_claim_count int, "
                                 "total_day_supply int, total_drug_cost decimal(18,2)")
    got = {(r.drug_name, r.prescriber_count) for r in marts.drug_spending(fact).collect()}
    assert got == {("B", 2), ("G", 1)}
    assert {r.drug for r in reports.top_drugs_from_fact(fact).collect()} == {"B", "G", "Unknown"}


def test_top_share_keeps_ties(spark):
    rows = [(f"d{i}", "g", 2024, 1, 1, D(10 if i < 9 else 5)) for i in range(12)]
    row = reports.top_share(spark.createDataFrame(rows, DRUGS), 10).first()
    assert (row.top_cost, row.total_cost) == (D(105), D(105))  # three drugs tie at the tenth place


def test_pareto_order_of_ties(spark):
    rows = [(n, "g", 2024, 1, 1, D(c)) for n, c in (("b", 5), ("a", 5), ("c", 10))]
    got = reports.pareto(spark.createDataFrame(rows, DRUGS), 2024, 2).orderBy("cum_cost").collect()
    assert [(r.drug_name, float(r.cum_cost), round(r.cum_pct, 4)) for r in got] == [("c", 10.0, 0.6667), ("a", 15.0, 1.0)]
    assert reports.pareto_cutoff(reports.pareto(spark.createDataFrame(rows, DRUGS), 2024, 2)).first().drugs_to_share == 1


def test_preview_has_a_row_per_state(spark):
    df = spark.createDataFrame([line("1", rate="0.3")] * 5 + [line("2", None)] * 5, UTIL)
    b = spark.createDataFrame([bench(state="TX", median="0.2"), bench(state="CA", median="0.4")], BENCH)
    got = reports.high_withhold_preview(df, b, 2024).collect()
    assert [(r.npi, r.specialty_median, r.high_withhold_flag) for r in got] == [("1", D("0.2000"), 1), ("1", D("0.4000"), 0)]


def test_preview_equals_the_full_join(spark):
    rows = [line(str(i), "ABC"[i % 3], "XYZ"[i % 3], f"0.{(i * 7) % 10}{j}") for i in range(40) for j in range(5)]
    df = spark.createDataFrame(rows, UTIL)
    b = spark.createDataFrame([bench(s, t, median=f"0.{i}{j}") for i, s in enumerate("AB") for j, t in enumerate("XYZ")], BENCH)
    got = [tuple(r) for r in reports.high_withhold_preview(df, b, 2024, 20).collect()]
    rated = reports.provider_rates(df, 2024, 5)
    medians = b.select(F.col("specialty").alias("cms_specialty"), "year", F.col("median_withhold_rate").alias("m"))
    full = rated.join(medians, ["cms_specialty", "year"]).orderBy(F.col("rate").desc(), "npi", "cms_specialty", "provider_state", "m")
    want = [(r.npi, r.cms_specialty, r.provider_state, r.year, round(r.rate, 4), r.m, int(r.rate > r.m), r.service_lines)
            for r in full.limit(20).collect()]
    assert got == want


def test_lookup_routing(spark):
    dim = spark.createDataFrame(
        [("1234567890", "Smith 100%", "a"), ("1234999999", "Blacksmith", "b"), ("77", "Jo", "c")], "npi string, display_name string, city string")
    for x in ("entity_type_label", "state", "primary_taxonomy_code", "credentials"):
        dim = dim.withColumn(x, F.lit("x"))
    assert [r.npi for r in lookup.lookup(dim, " 1234 ").collect()] == ["1234567890", "1234999999"]
    assert [r.npi for r in lookup.lookup(dim, "SMITH").collect()] == ["1234999999", "1234567890"]
    assert lookup.lookup(dim, " ").count() == 0 and lookup.lookup(dim, None).count() == 0
    assert lookup.lookup(dim, "12").count() == 2
    assert [lookup.lookup_by_name(dim, text).count() for text in ("0%", "%", "___", "\\", "m_t")] == [1, 1, 0, 0, 0]


def test_rankings_plan_as_top_k(spark):
    text = reports.top_outliers(spark.createDataFrame(
        [("1", "n", "s", "t", D(1), D(1), D(1), "High", 2024)],
        "npi string, provider_name string, cms_specialty string, provider_state string, avg_withhold_rate decimal(24,4), "
        "specialty_median_withhold decimal(24,4), withhold_vs_median decimal(24,4), withhold_risk_band string, year int"), 2024
    )._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text


def test_provider_year_first_step_is_a_hash_aggregate(spark):
    text = marts.provider_year(spark.createDataFrame([line()], UTIL))._jdf.queryExecution().executedPlan().toString()
    first = text[text.rindex("Exchange hashpartitioning"):]  # the part that reads the lines
    assert "HashAggregate" in first and "SortAggregate" not in first


def test_prescribers_are_counted_without_the_sums(spark):
    """What is shuffled by provider is the id and its group."""
    fact = spark.createDataFrame([], "npi string, drug_name string, generic_name string, year int, total_claim_count int, "
                                 "total_day_supply int, total_drug_cost decimal(18,2)")
    for made in (marts.drug_spending(fact), reports.top_drugs_from_fact(fact)):
        text = made._jdf.queryExecution().executedPlan().toString()
        sent = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "npi" in line]
        assert len(sent) == 1
        below = text[text.index(sent[0]):].splitlines()[1]
        assert "HashAggregate" in below and "sum(" not in below


def test_groups_without_a_name_or_year_keep_their_counts(spark):
    rows = [("1", "B", None, None, 1), ("2", "B", None, None, 2), (None, "B", None, 2024, 4), ("2", "B", "G", 2024, 8), ("2", "B", "G", 2024, 16)]
    fact = spark.createDataFrame([(*r, 1, D("1.00")) for r in rows], "npi string, drug_name string, generic_name string, year int, "
                                 "total_claim_count int, total_day_supply int, total_drug_cost decimal(18,2)")
    got = {(r.generic_name, r.year): (r.prescriber_count, r.total_claims) for r in marts.drug_spending(fact).collect()}
    assert got == {(None, None): (2, 3), (None, 2024): (0, 4), ("G", 2024): (1, 24)}
    got = {r.year: (r.prescriber_count, r.claims) for r in reports.top_drugs_from_fact(fact).collect()}
    assert got == {None: (2, 3), 2024: (1, 28)}


def test_benchmark_of_a_stored_table(spark):
    """The same rows; what is shuffled by provider has no sums."""
    lines = [line(str(i % 5), "ST"[i % 2] if i % 7 else None, "XY"[i % 3 % 2] if i % 4 else None, f"0.{i}", (None, 2023, 2024)[i % 3]) for i in range(40)]
    df = spark.createDataFrame([*lines, line(None), line("1", rate=None)], UTIL)
    got = [sorted(map(str, marts.specialty_benchmark(df, stored).drop("_updated_at").collect())) for stored in (False, True)]
    assert got[0] == got[1] and len(got[0]) > 5
    text = marts.specialty_benchmark(df, True)._jdf.queryExecution().executedPlan().toString()
    sent = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line and "npi" in line)
    assert "sum(" not in text[text.index(sent):].splitlines()[1]
