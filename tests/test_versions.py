from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylens.sources import raw, versions
from paylens.sources.files import SOURCE
from paylens.streaming.resume import resume_load

SCHEMA = f"a string, year string, {SOURCE} string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, path):
    return sorted(((r.a, r.year, r[SOURCE]) for r in versions.read(spark, path).collect()), key=str)


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, folder):
    path = folder + "/t"
    versions.publish(frame(spark, ("1", "2023", "x"), ("2", "2024", "y")), path, versions.TABLE)
    before = rows(spark, path)

    def dies(entries, where):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versions.publish(frame(spark, ("9", "2024", "y")), path, versions.YEAR, "2024", commit=dies)
    assert len(list(Path(path, "data").glob("v=*"))) == 2  # written, but no reader opens it
    assert rows(spark, path) == before
    versions.publish(frame(spark, ("3", "2024", "y")), path, versions.YEAR, "2024")  # the next load goes on from the old rows
    assert rows(spark, path) == [("1", "2023", "x"), ("3", "2024", "y")]


def test_what_a_commit_ends(spark, folder):
    path = folder + "/t"
    assert not versions.exists(spark, path)
    assert versions.publish(frame(spark, ("1", "2023", "x"), ("2", "2024", "x"), ("3", "2024", "y"), ("4", None, "z")), path, versions.TABLE) == 4
    versions.publish(frame(spark, ("5", "2024", "y")), path, versions.FILE)
    assert rows(spark, path) == [("1", "2023", "x"), ("2", "2024", "x"), ("4", None, "z"), ("5", "2024", "y")]
    versions.publish(frame(spark, ("6", "2024", "new")), path, versions.YEAR, "2024")
    assert rows(spark, path) == [("1", "2023", "x"), ("4", None, "z"), ("6", "2024", "new")]
    versions.publish(frame(spark, ("7", "2023", "z")), path, versions.FILE)  # a file's rows may move to another year
    assert rows(spark, path) == [("1", "2023", "x"), ("6", "2024", "new"), ("7", "2023", "z")]
    versions.publish(frame(spark).limit(0), path, versions.YEAR, "2023")  # a year without rows
    assert rows(spark, path) == [("6", "2024", "new")]
    assert {(r.year, r.rows) for r in versions.rows_by_year(spark, path).collect()} == {("2024", 1)}
    versions.publish(frame(spark, ("8", "2025", "w")), path, versions.TABLE)
    assert rows(spark, path) == [("8", "2025", "w")]
    assert versions.clear(spark, path) == 4 and rows(spark, path) == [("8", "2025", "w")]
    versions.publish(frame(spark).limit(0), path, versions.TABLE)
    assert rows(spark, path) == [] and versions.read(spark, path).columns == ["a", "year", SOURCE]


def test_rows_of_another_year_are_not_published(spark, folder):
    path = folder + "/t"
    versions.publish(frame(spark, ("1", "2023", "x")), path, versions.TABLE)
    with pytest.raises(ValueError, match="2 of 3 rows are not of 2024"):
        versions.publish(frame(spark, ("1", "2024", "x"), ("2", "2023", "x"), ("3", None, "x")), path, versions.YEAR, "2024")
    assert rows(spark, path) == [("1", "2023", "x")]


def test_columns_come_and_go(spark, folder):
    path = folder + "/t"
    versions.publish(frame(spark, ("1", "2023", "x")), path, versions.TABLE)
    versions.publish(frame(spark, ("2", "2024", "y")).withColumn("b", F.lit("new")).drop("a"), path, versions.YEAR, "2024")
    got = versions.read(spark, path).orderBy("year").collect()
    assert [(r.a, r.b, r.year) for r in got] == [("1", None, "2023"), (None, "new", "2024")]
    with pytest.raises(ValueError, match="two types"):
        versions.publish(frame(spark, ("2", "2025", "y")).withColumn("a", F.lit(1)), path, versions.YEAR, "2025")
        versions.read(spark, path)


def test_a_table_without_years(spark, folder):
    path = folder + "/t"
    make = lambda *r: spark.createDataFrame(list(r), f"a string, {SOURCE} string")
    versions.publish(make(("1", "x"), ("2", "y")), path, versions.TABLE)
    versions.publish(make(("3", "y")), path, versions.FILE)
    assert sorted(r.a for r in versions.read(spark, path).collect()) == ["1", "3"]


def test_a_read_of_one_year_opens_that_year_only(spark, folder):
    path = folder + "/t"
    versions.publish(spark.range(100).selectExpr("cast(id as string) a", "cast(2000 + id % 5 as string) as year", f"'x' as {SOURCE}"), path, versions.TABLE)
    one = versions.read(spark, path).filter("year = '2003'")
    assert one.select(F.count_distinct("_metadata.file_path")).first()[0] == one.select("_metadata.file_path").distinct().count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1].split("]")[0]
    assert one.count() == 20


def put(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_an_unchanged_file_is_not_read_again(spark, folder, monkeypatch):
    path = put(folder + "/in", "t_2024.csv", "a\n1\n2\n")
    put(folder + "/in", "t_2023.csv", "a\n0\n")
    raw.full_load(spark, folder + "/in", folder + "/raw")
    monkeypatch.setattr(raw, "load_files", lambda *args: pytest.fail("read"))
    assert raw.append_year(spark, path, folder + "/raw") == 0
    monkeypatch.undo()
    reads = []
    load = raw.load_files
    monkeypatch.setattr(raw, "load_files", lambda *args: reads.append(args) or load(*args))
    put(folder + "/in", "t_2024.csv", "a\n1\n2\n3\n")
    assert raw.append_year(spark, path, folder + "/raw") == 3 and len(reads) == 1
    assert raw.approx_rows(spark, folder + "/raw/t_2024").first().rows + raw.approx_rows(spark, folder + "/raw/t_2023").first().rows == 4


def test_a_replaced_file_is_loaded_again_by_the_stream(spark, folder):
    source, root, state = folder + "/in", folder + "/raw", folder + "/state"
    put(source, "t_2023.csv", "a\n1\n")
    put(source, "t_2024.csv", "a\n2\n")
    assert resume_load(spark, source, root, state) == 2
    put(source, "t_2024.csv", "a\n5\n66\n")
    assert resume_load(spark, source, root, state) == 1
    assert sorted(r.a for r in raw.read_raw(spark, root, "t_2024").collect()) == ["5", "66"]
    assert resume_load(spark, source, root, state) == 0
    assert sorted(r.a for r in raw.read_raw(spark, root, "t_2023").collect()) == ["1"]


def test_ragged_files_show_in_the_status(spark, folder):
    path = put(folder, "t_2024.csv", "a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.file_counts(spark, [path]).collect()


def test_the_manifest_is_not_counted_and_joined_by_one_task(spark, folder):
    plans = []

    def commit(entries, where):
        plans.append(entries._jdf.queryExecution().toString())
        versions._append(entries, where)

    versions.publish(frame(spark, ("1", "2023", "x"), ("2", "2024", "y")), folder + "/t", versions.TABLE, commit=commit)
    assert "Coalesce 1" not in plans[0]  # it pulls all partitions of the join into its task
    assert len(list(Path(folder, "t", "manifest").glob("part-*.parquet"))) == 1
    assert rows(spark, folder + "/t") == [("1", "2023", "x"), ("2", "2024", "y")]
