from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylens.sources import files, ledger, publish, raw
from paylens.streaming.resume import resume_load


def put(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def two_years(folder):
    put(folder, "cms_part_d_spending_2023.csv", " Prscrbr_NPI ,Brnd Name,Tot_Benes\n001,A,*\n002,NA,5\n")
    put(folder, "cms_part_d_spending_2024.csv", "Prscrbr_NPI,Brnd Name,Tot_Benes,Extra\n003,B,7,x\n")
    put(folder, "notes.txt", "no")
    return folder


def test_routes():
    assert files.route("/d/cms_part_d_spending_2024.csv") == ("cms_part_d_spending", "2024")
    assert files.route("/d/file=cms_part_d_spending_2024.csv/part-0001-77777.csv") == ("cms_part_d_spending", "2024")
    assert files.route("nppes_providers.csv") == ("nppes_providers", None)
    assert files.route("cms_part_d_spending_20245.csv") == ("cms_part_d_spending_20245", "2024")
    assert files.route("other.csv") == ("other", None)


def test_select_reports_missing_names(spark, folder):
    two_years(folder)
    got = files.select_files(files.list_files(spark, folder), ["CMS_part_d_spending_2024.CSV", "nope.csv"]).collect()
    assert [tuple(r) for r in got] == [("cms_part_d_spending_2024.csv", True), ("nope.csv", False)]
    assert [r.file for r in files.select_files(files.list_files(spark, folder)).collect()] == [
        "cms_part_d_spending_2023.csv", "cms_part_d_spending_2024.csv"]


def test_full_load(spark, folder):
    counts = raw.full_load(spark, two_years(folder + "/in"), folder + "/raw")
    assert [tuple(r) for r in counts.collect()] == [("cms_part_d_spending", 3)]
    got = raw.read_raw(spark, folder + "/raw", "cms_part_d_spending").orderBy("prscrbr_npi").collect()
    assert [(r.prscrbr_npi, r.brnd_name, r.tot_benes, r.extra, r.year) for r in got] == [
        ("001", "A", "*", None, "2023"), ("002", None, "5", None, "2023"), ("003", "B", "7", "x", "2024")]
    assert all(r["_loaded_at"] is not None for r in got)
    raw.full_load(spark, folder + "/in", folder + "/raw")  # replaces
    assert raw.read_raw(spark, folder + "/raw", "cms_part_d_spending").count() == 3


def test_a_bad_file_ends_the_load_after_the_others(spark, folder):
    two_years(folder + "/in")
    bad = put(folder + "/in", "cms_part_d_spending_2022.csv", "")
    ragged = put(folder + "/in", "cms_part_d_spending_2021.csv", "Prscrbr_NPI,Brnd Name\n1,A,extra\n")
    with pytest.raises(raw.LoadError) as caught:
        raw.full_load(spark, folder + "/in", folder + "/raw")
    assert {p.rsplit("/", 1)[-1] for p in caught.value.files} == {Path(p).name for p in (bad, ragged)}
    assert [tuple(r) for r in caught.value.loaded.collect()] == [("cms_part_d_spending", 3)]
    assert raw.read_raw(spark, folder + "/raw", "cms_part_d_spending").count() == 3


@pytest.mark.parametrize("line", ["4,5,6", "3"])
def test_ragged_rows_stop_the_read(spark, folder, line):
    path = put(folder, "t_2024.csv", f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_files(spark, [path], "2024-01-01").collect()


def test_parts_that_order_their_columns_differently(spark, folder):
    put(folder + "/t_2024.csv", "part-1.csv", "a,b\n1,2\n")
    put(folder + "/t_2024.csv", "part-2.csv", "b,a\n2,1\n")
    for frame in (files.read_raw_csv(spark, folder + "/t_2024.csv"), files.load_files(spark, [folder + "/t_2024.csv"], "2024-01-01")):
        assert [(r.a, r.b) for r in frame.collect()] == [("1", "2"), ("1", "2")]


def test_rows_of_another_year_are_never_dropped(spark, folder):
    path = put(folder, "t_2024.csv", "a,year\n1,2024\n2,2024.0\n3,\n4,2023\n")
    with pytest.raises(ValueError, match="3 of 4"):
        raw.append_year(spark, path, folder + "/raw")
    assert not raw.exists(spark, folder + "/raw/t_2024")


def test_a_grown_file_is_loaded_again(spark, folder):
    path = put(folder, "t_2024.csv", "a\n" + "".join(f"{i}\n" for i in range(98)))
    assert raw.append_year(spark, path, folder + "/raw") == 98
    put(folder, "t_2024.csv", "a\n" + "".join(f"{i}\n" for i in range(100)))
    spark.catalog.clearCache()
    assert raw.append_year(spark, path, folder + "/raw") == 100
    assert raw.read_raw(spark, folder + "/raw", "t_2024").count() == 100


def test_line_breaks_inside_quotes(spark, folder):
    path = put(folder, "t_2024.csv", 'a,b\n1,"x\ny"\n2,"say ""hi"""\n')
    other = put(folder, "u_2024.csv", 'a,b\n3,"p, q"\n')
    assert {Path(p.path).name: (p.header, p.whole) for p in files.survey(spark, [path, other])} == {"t_2024.csv": ("a,b", True), "u_2024.csv": ("a,b", False)}
    got = files.load_files(spark, [path, other], "2024-01-01").orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [("1", "x\ny"), ("2", 'say "hi"'), ("3", "p, q")]


def test_append_year(spark, folder):
    source = two_years(folder + "/in")
    raw.full_load(spark, source, folder + "/raw", only=["cms_part_d_spending_2023.csv"])
    path = f"{source}/cms_part_d_spending_2024.csv"
    assert raw.append_year(spark, path, folder + "/raw") == 1
    assert raw.append_year(spark, path, folder + "/raw") == 0  # complete
    assert raw.append_year(spark, path, folder + "/raw", replace=True) == 1
    assert raw.read_raw(spark, folder + "/raw", "cms_part_d_spending").count() == 3
    with pytest.raises(ValueError):
        raw.append_year(spark, put(source, "other.csv", "a\n1\n"), folder + "/raw")


def test_replace_year_drops_what_was_there(spark, folder):
    raw.full_load(spark, two_years(folder + "/in"), folder + "/raw")
    new = spark.createDataFrame([("9", "2023", "again.csv")], f"prscrbr_npi string, year string, {files.SOURCE} string")
    raw.replace_year(new, folder + "/raw", "cms_part_d_spending", 2023)
    got = raw.read_raw(spark, folder + "/raw", "cms_part_d_spending").orderBy("year").collect()
    assert [(r.year, r.prscrbr_npi) for r in got] == [("2023", "9"), ("2024", "003")]


def test_resume_loads_each_file_once(spark, folder):
    source, root, state = two_years(folder + "/in"), folder + "/raw", folder + "/state"
    assert resume_load(spark, source, root, state) == 2
    assert resume_load(spark, source, root, state) == 0
    put(source, "nppes_providers.csv", "NPI\n1\n2\n")
    assert resume_load(spark, source, root, state) == 1
    assert raw.read_raw(spark, root, "cms_part_d_spending").count() == 3
    assert raw.read_raw(spark, root, "nppes_providers").count() == 2
    # a lost checkpoint loads everything again, without doubling it
    assert resume_load(spark, source, root, folder + "/other") == 3
    assert raw.read_raw(spark, root, "cms_part_d_spending").count() == 3


def test_resume_with_one_part_per_batch(spark, folder):
    spark.range(100).selectExpr("cast(id as string) id").repartition(4).write.option("header", True).csv(folder + "/in/t_2024.csv")
    assert resume_load(spark, folder + "/in", folder + "/raw", folder + "/state", files_per_batch=1) == 4
    assert raw.read_raw(spark, folder + "/raw", "t_2024").select("id").distinct().count() == 100


def test_load_status(spark):
    counts = spark.createDataFrame([("a_2024.csv", 100), ("b.csv", 100), ("c.csv", 100), ("d.csv", 0), ("e.csv", 0)], "file string, file_rows bigint")
    loaded = spark.createDataFrame(
        [("a_2024", "2024", 98), ("a_2024", "2023", 500), ("b", None, 50), ("e", None, 1)], "table string, year string, table_rows bigint")
    got = {r.file: r.status for r in raw.load_status(files.route_files(counts), loaded).collect()}
    assert got == {"a_2024.csv": "98% DONE", "b.csv": "50% DONE", "c.csv": "NOT STARTED", "d.csv": "COMPLETE", "e.csv": "COMPLETE"}


def test_file_counts(spark, folder):
    path = put(folder, "t_2024.csv", 'a,b\n1,"x\ny"\n2,z\n')
    assert [(r.file, r.file_rows, r.table) for r in raw.file_counts(spark, [path]).collect()] == [("t_2024.csv", 2, "t_2024")]


def test_approx_rows(spark, folder):
    spark.range(123).write.parquet(folder + "/t")
    assert raw.approx_rows(spark, folder + "/t").first().rows == 123
    assert raw.approx_rows(spark, folder + "/none").first().rows == 0


def test_catalog_rows(spark, folder):
    spark.range(123).write.parquet(folder + "/t")
    spark.sql(f"create table counted using parquet location '{folder}/t'")
    assert raw.catalog_rows(spark, "counted") is None
    spark.sql("analyze table counted compute statistics")
    assert raw.catalog_rows(spark, "counted") == 123
    spark.sql("drop table counted")  # external: the files stay


def test_ledger(spark, folder):
    path = folder + "/runs"
    run = ledger.record_run(spark, path, {"pipeline_name": "p", "status": "running"})
    ledger.record_run(spark, path, {"pipeline_name": "p", "status": "success", "run_id": run, "steps": [
        {"name": "load", "status": "success", "duration_sec": 1.5, "detail": "d"}]})
    ledger.record_run(spark, path, {"pipeline_name": "p", "status": "failed", "error_message": "boom"})
    runs = ledger.current_runs(spark.read.parquet(path))
    assert {(r.run_id == run, r.status, len(r.steps)) for r in runs.collect()} == {(True, "success", 1), (False, "failed", 0)}
    assert ledger.latest_runs(runs, 1).first().status == "failed"
    with pytest.raises(ValueError):
        ledger.record_run(spark, path, {"pipeline_name": "p", "status": "odd"})


def test_publish_and_export(spark, folder):
    risk = spark.range(1_000).select(
        F.col("id").cast("string").alias("provider_risk_id"),
        F.when(F.col("id") % 2 == 0, "High").otherwise("Low").alias("withhold_risk_band"))
    tables = {"anl_provider_withhold_risk": risk}
    got = publish.publish(tables, folder, {"anl_provider_withhold_risk": 10}).collect()
    assert [tuple(r) for r in got] == [("anl_provider_withhold_risk", 1_000, 10)]
    assert spark.read.parquet(folder + "/anl_provider_withhold_risk").count() == 10
    assert publish.publish(tables, folder + "/none", {}, dry_run=True).first().published_rows == 1_000
    assert not Path(folder + "/none").exists()
    assert publish.publish(tables, folder + "/all").first().published_rows == 1_000
    publish.export_csv(tables, folder + "/thin", ["anl_provider_withhold_risk"], {"High": 7, "Low": 600})
    assert files.read_raw_csv(spark, folder + "/thin/anl_provider_withhold_risk").count() == 507
    publish.export_csv(tables, folder + "/csv", ["anl_provider_withhold_risk"])
    back = files.read_raw_csv(spark, folder + "/csv/anl_provider_withhold_risk")
    assert back.columns == risk.columns and back.count() == 1_000


def test_names_and_years_are_worked_out_once_for_a_file(spark, folder):
    put(folder, "file=t_2023.csv/part-0.csv", "a\n1\n")
    put(folder, "t_2024.csv", 'a\n"2\n2"\n')
    put(folder, "u.csv", "a,Year\n3,1999\n4,NA\n")
    paths = [row.path for row in files.list_files(spark, folder).collect()]
    loaded = files.load_files(spark, paths, "2024-01-01 00:00:00")
    got = sorted(((r.a, r[files.SOURCE], r.year) for r in loaded.collect()), key=str)
    assert got == [("1", "t_2023.csv/part-0.csv", "2023"), ("2\n2", "t_2024.csv", "2024"), ("3", "u.csv", "1999"), ("4", "u.csv", None)]
    assert loaded.columns == ["a", files.SOURCE, "year", "_loaded_at"]
    few = loaded.filter((F.col("year").cast("int") < 2000) | (F.col("year").cast("int") == 2023))
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan  # neither in the scans nor in the filters inferred for them
    assert few.count() == 2
