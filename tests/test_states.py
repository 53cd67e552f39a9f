import threading

import pytest
from pyspark.sql import functions as F

from paylens.contract.registry import Data
from paylens.plans import marts
from paylens.plans.states import YearStates
from paylens.sources import versions


@pytest.fixture(scope="module")
def frames(spark):
    data = Data(spark, "/root/testdata/sf0.001")
    odd = data.fact().withColumn("npi", F.when(F.col("total_claim_count") % 5 == 0, F.concat(F.lit("0"), "npi")).otherwise(F.col("npi")))
    return data.utilization().persist(), odd.persist(), data.dim().persist()


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(set(df.columns) - {"_updated_at"})).collect()))


def compare(states, utilization, fact, dim):
    assert rows(states.benchmark()) == rows(marts.specialty_benchmark(utilization))
    assert rows(states.drugs()) == rows(marts.drug_spending(fact))
    whole = marts.kpi_overview(dim, marts.specialty_benchmark(utilization), fact)
    assert rows(states.kpi(dim)) == rows(whole)


def test_year_by_year_as_all_at_once(spark, folder, frames):
    utilization, fact, dim = frames
    years = sorted(r.year for r in fact.select("year").union(utilization.select("year")).distinct().collect())
    states = YearStates(spark, folder)
    states.put(years[:-1], utilization, fact)
    states.put(years[-1:], utilization, fact)
    compare(states, utilization, fact, dim)
    # a year that changes, and one that loses its rows
    fewer = fact.filter((F.col("year") != years[0]) | (F.col("total_claim_count") > 10))
    states.put([years[0]], utilization, fewer)
    states.put([years[1]], utilization.limit(0), fact.limit(0))
    left = F.col("year") != years[1]
    compare(states, utilization.filter(left), fewer.filter(left), dim)


def test_a_new_year_reads_its_own_rows_only(spark, folder, frames):
    """The other years' files are gone, so any read of them would fail."""
    utilization, fact, _ = frames
    for name, df in (("u", utilization), ("f", fact)):
        df.filter("year = 1999").drop("_loaded_at").write.parquet(f"{folder}/{name}/year=1999")
    read = lambda name: spark.read.parquet(f"{folder}/{name}/year=1999").withColumn("year", F.lit(1999))
    states = YearStates(spark, folder + "/states")
    states.put([1998], utilization, fact)
    before = states.drugs().filter("year = 1998").count()
    out = states.put([1999], read("u"), read("f"))
    assert out["drugs"] == states.drugs().filter("year = 1999").count() and states.drugs().filter("year = 1998").count() == before


def test_states_are_written_at_the_same_time(spark, folder, frames, monkeypatch):
    """None is published before all of them have begun."""
    utilization, fact, _ = frames
    names = {"benchmark", "drugs", "costs", "ids", "names"}
    begun = threading.Barrier(len(names), timeout=20)
    monkeypatch.setattr(versions, "publish", lambda state, path, *rest, **signed: begun.wait() * 0 + len(path.split("/")[-1]))
    assert YearStates(spark, folder).put([1999], utilization, fact) == {name: len(name) for name in names}
