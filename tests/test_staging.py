from datetime import datetime

from pyspark.sql import functions as F

from paylens import contracts as k
from paylens.operators.dedupe import latest_per_key, one_per_key
from paylens.operators.joins import hot_keys
from paylens.plans import enrich, staging
from paylens.plans.build import Warehouse

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def spending(spark, *rows):
    """Rows of (npi, brand, generic, benes, cost, year, loaded)."""
    names = "prscrbr_npi string, brnd_name string, gnrc_name string, tot_benes string, tot_drug_cst string, year string, _loaded_at timestamp"
    df = spark.createDataFrame(list(rows), names)
    for x in ("prscrbr_last_org_name", "prscrbr_first_name", "prscrbr_city", "prscrbr_state_abrvtn", "prscrbr_type"):
        df = df.withColumn(x, F.lit("own"))
    return df.withColumn("tot_clms", F.lit("3")).withColumn("tot_day_suply", F.lit("90"))


def test_spending_columns_types_and_key_filter(spark):
    out = staging.stage_spending(spending(
        spark, ("1", "B", "G", "*", "12.345", "2023", T1), ("", "B", "G", "1", "1", "2023", T1),
        (None, "B", "G", "1", "1", "2023", T1)))
    assert out.columns == [
        "spending_id", "npi", "provider_name", "provider_first_name", "provider_city", "provider_state", "specialty",
        "drug_name", "generic_name", "bene_count", "total_claim_count", "total_day_supply", "total_drug_cost", "year",
        "_loaded_at"]
    row = out.collect()
    assert len(row) == 1 and row[0].bene_count is None and str(row[0].total_drug_cost) == "12.35" and row[0].year == 2023


def test_newest_load_wins_and_null_load_loses(spark):
    out = staging.stage_spending(spending(
        spark, ("1", "B", "G", "1", "10", "2023", T1), ("1", "B", "G", "1", "20", "2023", T2),
        ("1", "B", "G", "1", "30", "2023", None), ("1", None, "G", "1", "40", "2023", T1),
        ("1", "", "G", "1", "50", "2023", T2)))
    # a null and an empty brand have the same id
    assert sorted(float(r.total_drug_cost) for r in out.collect()) == [20.0, 50.0]


def test_ids_that_join_to_the_same_text_are_one(spark):
    out = staging.stage_spending(spending(
        spark, ("1", "A-B", "C", "1", "10", "2023", T1), ("1", "A", "B-C", "1", "20", "2023", T2)))
    assert [float(r.total_drug_cost) for r in out.collect()] == [20.0]


def test_ties_do_not_depend_on_the_row_order(spark):
    rows = [("1", "B", "G", str(i), str(i), "2023", T1) for i in range(20)]
    one = staging.stage_spending(spending(spark, *rows)).drop("_loaded_at").collect()
    two = staging.stage_spending(spending(spark, *rows[::-1]).repartition(3)).drop("_loaded_at").collect()
    assert one == two


def test_latest_and_one_per_key(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 2, "x"), ("a", 1, "z"), ("b", None, "q")], "k string, o int, v string")
    got = latest_per_key(df, ["k"], [F.col("o").desc_nulls_last()], ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 2, "x"), ("b", None, "q")]
    assert one_per_key(df, "k").count() == 2


def registry(spark, *rows):
    names = [*k.REGISTRY_TEXT, k.REGISTRY_ORG_LEGAL, k.REGISTRY_ORG_OTHER]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"`{n}` string" for n in names))


def test_registry_and_enrichment(spark):
    raw = registry(
        spark, {"npi": "1", "entity_type_code": "2", k.REGISTRY_ORG_OTHER: "Other", "healthcare_provider_taxonomy_code_1": "TX"},
        {"npi": "1", "entity_type_code": "2", k.REGISTRY_ORG_OTHER: "Other"}, {"npi": ""}, {"npi": None})
    provider = enrich.providers(staging.stage_providers(raw))
    assert [(r.npi, r.display_name, r.entity_type_label) for r in provider.collect()] == [("1", "Other", "organization")]
    facts = staging.stage_spending(spending(
        spark, ("1", "B", "G", "1", "10", "2023", T1), ("2", "B", "G", "1", "20", "2023", T1)))
    got = {r.npi: r for r in enrich.enrich_spending(facts, provider).collect()}
    assert (got["1"].provider_name, got["1"].provider_state, got["1"].provider_taxonomy_or_specialty) == ("Other", "own", "TX")
    assert (got["2"].provider_name, got["2"].provider_state, got["2"].entity_type_label) == ("own", "own", None)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_and_id_filters_reach_the_scan_through_the_dedupe(spark, folder):
    spending(spark, ("1", "B", "G", "1", "10", "2023", T1), ("1", "B", "G", "1", "10", "2024", T1)).write.partitionBy(
        "year").parquet(folder + "/raw")
    raw = spark.read.parquet(folder + "/raw").withColumn("year", F.col("year").cast("string"))
    text = plan(staging.stage_spending(raw).filter("year = 2024 and npi = '1'"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "2024" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(prscrbr_npi,1)" in scan


def test_copies_are_dropped_before_the_shuffle(spark):
    raw = spending(spark, ("1", "B", "G", "1", "10", "2023", T1))
    text = plan(staging.stage_spending(raw))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_rows_of_a_fact_are_shuffled_once(spark, folder):
    rows = [("1", f"B{i % 7}", None, "1", str(i), "2023", T1) for i in range(60)]  # more rows than an average partition
    rows += [(str(2 + i % 9), f"B{i % 3}", "G", "1", str(i), str(2023 + i % 2), (T1, T2)[i % 2]) for i in range(40)]
    rows += [("", "B", "G", "1", "1", "2023", T1), (None, "B", "G", "1", "1", "2023", T1)]
    raw = spending(spark, *rows).repartition(3)
    people = [{"npi": str(i), "entity_type_code": "2", k.REGISTRY_ORG_OTHER: f"Org {i}"} for i in (1, 2, 3, 99)]
    provider = enrich.providers(staging.stage_providers(registry(spark, *people))).drop("_updated_at")
    plain = enrich.enrich_spending(staging.stage_spending(raw), provider).drop("_loaded_at")
    wanted = sorted(map(str, plain.collect()))
    house = Warehouse(spark, folder, {"cms_part_d_spending": raw})
    provider.write.parquet(f"{folder}/int_providers")
    for limit, shuffle in (("10m", "rangepartitioning(year"), ("-1", "hashpartitioning(npi")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            facts = house.plan("int_spending_enriched")
            text = plan(facts)
            assert "_salt" not in text
            assert [shuffle in x for x in text.splitlines() if "REPARTITION_BY_COL" in x and "_spot" not in x].count(True) >= 1
            assert sum("Exchange" in x and "_spot" in x for x in text.splitlines()) == 1  # the few providers with very many rows
            assert sorted(map(str, facts.drop("_loaded_at").collect())) == wanted
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert house.write("int_spending_enriched") == len(wanted)
    assert sorted(map(str, house.table("int_spending_enriched").select(*plain.columns).collect())) == wanted


def test_weighted_hot_keys(spark):
    sizes = spark.createDataFrame([("1", 5), ("1", 4), ("2", 1), ("3", 2)], "npi string, rows long")
    assert [r.npi for r in hot_keys(sizes, ["npi"], 0.5, "rows").collect()] == ["1"]


def test_a_row_comes_back_as_it_went(spark):
    odd = [None, "", "a", " ", "-", "\u0001", "\u0002", "a\u0001", "\u0002b", "\\", "é\u0003", "\u0001\u0002", "x" * 99]
    rows = [(str(i), x, y, i, odd[(i * 5) % 13]) for i, (x, y) in enumerate((x, y) for x in odd for y in odd)]
    typed = spark.createDataFrame([*rows, (None, None, None, None, None), (None, "", None, 1, "")], "npi string, a string, b string, n int, c string")
    for some in (typed, typed.select("npi", "n"), typed.select("a")):
        got = staging.dealt(some, lambda x: x.repartition(3))
        assert got.dtypes == some.dtypes and sorted(map(str, got.collect())) == sorted(map(str, some.collect()))


def test_texts_are_shuffled_as_one(spark):
    raw = spending(spark, ("1", "B", "G", "1", "10", "2023", T1))
    text = staging.stage_spending(raw, lambda x: x.repartition("npi"))._jdf.queryExecution().executedPlan().toString()
    sent = text.split("REPARTITION_BY_COL")[1]  # below the shuffle
    assert "AS _texts" in sent and "AS _parts" in text.split("REPARTITION_BY_COL")[0]


def test_without_a_hot_provider_a_fact_is_read_once(spark):
    raw = spending(spark, *((str(i), "B", "G", "1", str(i), "2023", T1) for i in range(40)))
    provider = enrich.providers(staging.stage_providers(registry(spark, {"npi": "1", k.REGISTRY_ORG_OTHER: "Org"})))
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            facts = enrich.spending(raw, provider)
            text = plan(facts)
            assert "Union" not in text and text.count("prscrbr_city") == plan(staging.stage_spending(raw)).count("prscrbr_city")
            assert sorted(r.npi for r in facts.collect()) == sorted(str(i) for i in range(40))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
