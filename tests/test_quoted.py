import csv
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paylens.sources import files, quoted


def put(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    return str(path)


def made(rows, seed=0, end="\n"):
    """CSV text with quotes, doubled quotes, separators and line breaks inside quotes."""
    draw = random.Random(seed)
    cell = lambda: "".join(draw.choice(["x", "yz", '""', ",", end, " ", "1"]) for _ in range(draw.randint(0, 8)))
    out = io.StringIO()
    out.write(f"id,a,b{end}")
    for k in range(rows):
        out.write(f'{k},"{cell()}","{cell()}"{end}' if draw.random() < 0.7 else f"{k},plain,{k}{end}")
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 256)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(4))
def test_same_rows_as_the_whole_file_parse(spark, folder, small_splits, seed):
    text = made(300, seed)
    path = put(folder, "t.csv", text)
    ids = [r[0] for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    whole = spark.read.options(**files.CSV_OPTIONS).option("multiLine", True).csv(path)
    got = files.load_files(spark, [path], "2024-01-01")
    key = lambda r: int(r[0])
    rows = sorted(((r.id, r.a, r.b) for r in got.collect()), key=key)
    assert rows == sorted(((r.id, r.a, r.b) for r in files.null_tokens(whole).collect()), key=key)
    assert [r[0] for r in rows] == ids


def test_many_tasks_read_the_file(spark, folder, small_splits):
    path = put(folder, "t.csv", 'id,a\n0,"one\nbreak"\n' + "".join(f"{k},x\n" for k in range(1, 2000)))
    frame = quoted.numbered_lines(spark, [path])
    assert frame.select("split").distinct().count() > 20
    got = files.read_raw_csv(spark, path)
    assert got.count() == 2000 and got.filter("id = '0'").first().a == "one\nbreak"


def test_a_record_over_several_splits(spark, folder, small_splits):
    long = "\n".join(f"line {k} of a long text" for k in range(100))
    path = put(folder, "t.csv", f'id,a,b\n1,"{long}",x\n2,"{long} ""quoted""\n",y\n\n3,z,"{long}"')
    rows = files.read_raw_csv(spark, path).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in rows] == [("1", long, "x"), ("2", f'{long} "quoted"\n', "y"), ("3", "z", long)]


def test_windows_line_ends_and_two_files(spark, folder, small_splits):
    one = put(folder, "t_2023.csv", 'id,a\r\n1,"x\r\ny"\r\n2,z\r\n')
    two = put(folder, "t_2024.csv", 'id,a\n3,"p\nq"\n')
    got = files.load_files(spark, [one, two], "2024-01-01").orderBy("id").collect()
    assert [(r.id, r.a.replace("\r", ""), r.year, r[files.SOURCE]) for r in got] == [
        ("1", "x\ny", "2023", "t_2023.csv"), ("2", "z", "2023", "t_2023.csv"), ("3", "p\nq", "2024", "t_2024.csv")]


@pytest.mark.parametrize("row", ['4,"x\ny",6', '"3\n"'])
def test_ragged_rows_stop_the_read(spark, folder, row):
    path = put(folder, "t.csv", f'id,a\n1,"b\nc"\n{row}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_files(spark, [path], "2024-01-01").collect()


def test_unread_columns_are_checked_too(spark, folder):
    path = put(folder, "t.csv", 'id,a\n1,"b\nc"\n2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_files(spark, [path], "2024-01-01").select(F.col("id")).collect()
