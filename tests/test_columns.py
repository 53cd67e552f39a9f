from decimal import Decimal as D
from hashlib import md5

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paylens.functions import columns as c


def values(df, *cols):
    return [tuple(r) if len(cols) != 1 else r[0] for r in df.select(*cols).collect()]


def test_suppressed_int(spark):
    df = spark.createDataFrame([("",), ("*",), ("NA",), (None,), ("15",)], "v string")
    assert values(df, c.suppressed_int("v")) == [None, None, None, None, 15]


def test_other_text_in_a_count_raises(spark):
    df = spark.createDataFrame([("11.0",)], "v string")
    with pytest.raises(PySparkException):
        df.select(c.suppressed_int("v")).collect()


def test_withhold_rate(spark):
    rows = [("0", "1"), (None, "1"), ("100", "80"), ("100", "120"), ("200", "175.31"), ("20000", "17531")]
    df = spark.createDataFrame(rows, "a string, p string").selectExpr(
        "cast(a as decimal(18,2)) a", "cast(p as decimal(18,2)) p")
    got = values(df, c.withhold_rate("p", "a"))
    # 0.12345 is half-way and rounds away from zero
    assert got == [None, None, D("0.2000"), D("-0.2000"), D("0.1235"), D("0.1235")]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("1", None, 2023), (None, "x", 2023)], "a string, b string, y int")
    assert values(df, c.surrogate_key(["a", "b", "y"])) == [
        md5(b"1--2023").hexdigest(), md5(b"-x-2023").hexdigest()]
    assert values(df, c.surrogate_key(["a", "b", "y"], strict=["a"])) == [md5(b"1--2023").hexdigest(), None]


def test_display_name_and_label(spark):
    rows = [("1", "2", "  ", None, None), ("2", "2", " Clinic ", None, None), ("3", "1", None, None, "Lee"),
            ("4", "1", None, None, None), ("5", "9", None, "Al", "Lee"), ("6", None, "Org", None, None)]
    df = spark.createDataFrame(rows, "npi string, e string, org string, first string, last string")
    assert values(df, c.display_name("e", "org", "first", "last", "npi")) == ["1", "Clinic", "Lee", "4", "Al Lee", "6"]
    assert values(df, c.entity_label("e")) == [
        "organization", "organization", "individual", "individual", "unknown", "unknown"]


def test_require_keys(spark):
    df = spark.createDataFrame([("1", "a"), (None, "a"), ("", "a"), ("1", None), ("1", "")], "npi string, code string")
    assert values(c.require_keys(df, ["npi", "code"]), "npi", "code") == [("1", "a")]


def test_nullish(spark):
    rows = [(None,), ("",), ("  ",), ("NaN",), (" none",), ("NULL",), ("<na>",), ("x",), ("0",)]
    df = spark.createDataFrame(rows, "v string")
    assert values(df, c.is_nullish("v")) == [True] * 7 + [False] * 2


def test_null_tokens_in_text_columns_only(spark):
    df = spark.createDataFrame([("NA", 1), ("n/a", 2), ("ok", 3), ("", 4), (None, 5)], "v string, n int")
    assert values(c.null_tokens(df), "v", "n") == [(None, 1), (None, 2), ("ok", 3), (None, 4), (None, 5)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" NPI  Code (Legal) ", "Tot\t Benes")
    assert c.normalize_headers(df).columns == ["npi_code_(legal)", "tot_benes"]


def test_exact_mean_does_not_round_twice(spark):
    # 1.23449999999 must give 1.2345 only if rounded twice
    df = spark.createDataFrame([(D("1.2344"),)] * 3 + [(D("1.2346"),)], "v decimal(18,4)")
    assert values(df.agg(c.exact_mean("v", 4).alias("m")), "m") == [D("1.2345")]  # 1.23445 half-way
    many = spark.range(100_001).select(F.when(F.col("id") < 50_000, D("0.1234")).otherwise(D("0.1235")).cast("decimal(18,4)").alias("v"))
    assert values(many.agg(c.exact_mean("v", 4).alias("m")), "m") == [D("0.1235")]  # just above half


def test_weighted_mean_of_no_weight_is_null(spark):
    df = spark.createDataFrame([(D("0.5"), 0)], "v decimal(18,4), w bigint")
    assert values(df.agg(c.weighted_mean("v", "w").alias("m")), "m") == [None]


def test_median_of_histogram_equals_median(spark):
    df = spark.range(999).selectExpr("cast((id * 37 % 101) / 100 as decimal(18,4)) as v")
    plain = df.agg(c.tidy_double(c.exact_median("v"), 4).alias("m")).first().m
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    assert counts.agg(c.tidy_double(c.exact_median("v", F.col("n")), 4).alias("m")).first().m == plain
    even = spark.createDataFrame([(D("0.1234"),), (D("0.1235"),)], "v decimal(18,4)")
    assert even.agg(c.tidy_double(c.exact_median("v"), 4).alias("m")).first().m == D("0.1235")


def test_short_label(spark):
    df = spark.createDataFrame([("x" * 50,)], "v string")
    assert values(df, F.length(c.short_label("v", 40))) == [40]


def test_approximate_median_is_close(spark):
    df = spark.range(10_001).selectExpr("cast(id as decimal(18,4)) as v")
    assert abs(df.agg(c.approx_median("v").alias("m")).first().m - 5_000) <= 1
