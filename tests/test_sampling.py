from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paylens.operators.sampling import sample_n, stratified_cap


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def brute(df, n, seed=42):
    rows = df.select("id", F.xxhash64("id", F.lit(seed)).alias("h")).collect()
    return sorted(r.id for r in sorted(rows, key=lambda r: r.h & (2**64 - 1))[:n])


def test_exact_size_and_the_smallest_hashes(spark):
    df = spark.range(20_000)
    for n in (1, 10, 777, 19_999):
        assert ids(sample_n(df, n, ["id"])) == brute(df, n)


def test_fewer_rows_than_asked(spark):
    assert ids(sample_n(spark.range(10), 10, ["id"])) == list(range(10))
    assert ids(sample_n(spark.range(10), 500, ["id"])) == list(range(10))
    assert ids(sample_n(spark.range(0), 5, ["id"])) == []


def test_repeatable_whatever_the_partitioning(spark):
    df = spark.range(5_000)
    assert ids(sample_n(df, 100, ["id"])) == ids(sample_n(df.repartition(7), 100, ["id"]))
    assert ids(sample_n(df, 100, ["id"], seed=1)) != ids(sample_n(df, 100, ["id"], seed=2))


@settings(max_examples=6, deadline=None)
@given(rows=st.integers(0, 300), n=st.integers(1, 300))
def test_size_property(spark, rows, n):
    assert sample_n(spark.range(rows), n, ["id"]).count() == min(rows, n)


def test_stratified_cap_drops_other_strata(spark):
    df = spark.range(3_000).withColumn("band", F.element_at(F.array(F.lit("High"), F.lit("Low"), F.lit("At Median")), (F.col("id") % 3 + 1).cast("int")))
    got = {r.band: r["count"] for r in stratified_cap(df, "band", {"High": 100, "Low": 5_000}, ["id"]).groupBy("band").count().collect()}
    assert got == {"High": 100, "Low": 1_000}


def test_strata_are_the_samples_of_each(spark):
    """A stratum with most of the rows, a small one, one that gets nothing, nulls and one that is not there."""
    band = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, "small").when(F.col("id") % 10 == 8, "none")
    df = spark.range(4_000).withColumn("band", band)
    caps = {"hot": 900, "small": 399, "none": 0, "absent": 5}
    got = stratified_cap(df, "band", caps, ["id"], seed=3)
    assert got.columns == df.columns
    want = [i for value, n in caps.items() for i in ids(sample_n(df.filter(F.col("band") == value), n, ["id"], 3))]
    assert ids(got) == sorted(want) and len(want) == 1_299
    assert stratified_cap(df, "band", {}, ["id"]).collect() == [] and stratified_cap(df.limit(0), "band", caps, ["id"]).collect() == []


def test_more_strata_take_no_more_scans(spark, folder):
    spark.range(100).selectExpr("id", "cast(id % 5 as string) as band").write.parquet(folder + "/rows")
    df = spark.read.parquet(folder + "/rows")
    scans = [stratified_cap(df, "band", {str(i): 9 for i in range(k)}, ["id"])._jdf.queryExecution().optimizedPlan().toString().count("parquet") for k in (1, 5)]
    assert scans[0] == scans[1]
