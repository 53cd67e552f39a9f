from itertools import accumulate

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paylens.operators.classifier import roc_auc
from paylens.operators.running import running_sums, sliced
from paylens.plans.reports import pareto

ROWS = "id long, g string, v long"


def plain(rows, group):
    """Running sums by a walk over one group's rows, null while only nulls came."""
    values = [v for i, g, v in sorted(rows) if g == group]
    sums = accumulate(values, lambda a, v: a if v is None else v if a is None else a + v)
    return list(sums)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-9, 9))), max_size=60), slices=st.sampled_from([1, 3, 16]))
def test_sums_equal_a_walk(spark, values, slices):
    rows = [(i, g, v) for i, (g, v) in enumerate(values)]
    got = running_sums(spark.createDataFrame(rows, ROWS), [F.col("id").asc()], {"upto": "v"}, ["g"], slices, {"all": "v"}).collect()
    assert len(got) == len(rows)
    for group in {g for _, g, _ in rows}:
        mine = sorted((r for r in got if r.g == group), key=lambda r: r.id)
        want = plain(rows, group)
        assert [r.upto for r in mine] == want and {r["all"] for r in mine} == {want[-1]}


def test_slices_stay_even_when_values_bunch(spark):
    scores = spark.range(4_000).selectExpr("0.5 + id / 1e9 as _s")
    sizes = [r["count"] for r in sliced(scores, ["_s"], 16).groupBy("_slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 300


def test_slices_are_ranges(spark):
    rows = sliced(spark.range(5_000).selectExpr("id * 7919 % 5000 as v"), [F.col("v").desc()], 8)
    bounds = [(r.low, r.high) for r in rows.groupBy("_slice").agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("_slice").collect()]
    assert len(bounds) == 8 and all(a[0] > b[1] for a, b in zip(bounds, bounds[1:]))


def test_a_hot_group_is_spread(spark):
    rows = spark.range(6_000).selectExpr("id", "if(id % 3 = 0, 'x' || id, 'hot') as g", "1L as v")
    slices = sliced(rows, ["g", "id"], 12).filter("g = 'hot'").select("_slice").distinct().count()
    assert slices >= 6
    sums = running_sums(rows, [F.col("id").asc()], {"upto": "v"}, ["g"], 12)
    assert sums.filter("g = 'hot'").agg(F.max("upto"), F.count_distinct("upto")).first()[:] == (4_000, 4_000)


def test_no_array_of_cuts_in_the_plans(spark):
    points = spark.range(100).selectExpr("cast(id % 2 as int) as is_high_risk", "id / 100 as score")
    drugs = spark.range(50).selectExpr("'d' || id as drug_name", "'g' as generic_name", "2024 as year", "id as prescriber_count", "id as total_claims",
                                       "cast(id as decimal(28,2)) as total_medicare_cost")
    for frame in (roc_auc(points), pareto(drugs, 2024)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in plan and "percentile" not in plan


def test_empty_and_repeated_rows(spark):
    none = spark.createDataFrame([], ROWS)
    assert running_sums(none, [F.col("id").asc()], {"upto": "v"}).collect() == []
    same = spark.createDataFrame([(1, "a", 2)] * 5, ROWS)
    assert sorted(r.upto for r in running_sums(same, [F.col("id").asc()], {"upto": "v"}).collect()) == [2, 4, 6, 8, 10]
