"""Every registered query that has a DuckDB check, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import compare
from paylens.contract.registry import GIVEN

PATH = "/root/testdata/sf0.001"
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for table in GIVEN:
        con.sql(f"create view {table} as select * from '{PATH}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_duckdb(spark, duck, name):
    assert compare(entry_points.queries()[name](spark, PATH), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_a_failing_step_is_recorded(spark, folder):
    from paylens.plans.build import build
    from paylens.sources.ledger import current_runs

    with pytest.raises(KeyError):
        build(spark, {}, folder + "/tables", ledger=folder + "/runs")
    row = current_runs(spark.read.parquet(folder + "/runs")).first()
    assert row.status == "failed" and row.steps[-1].name == "error" and row.finished_at is not None


def test_layers_can_be_built_one_by_one(spark, folder):
    from paylens.contract.registry import Data, Y0, Y1
    from paylens.plans.build import build

    data = Data(spark, PATH)
    sources = {
        "cms_part_d_spending": data.raw_spending(), "cms_provider_utilization": data.raw_utilization(),
        "nppes_providers": data.raw_registry(),
    }
    with pytest.raises(ValueError):
        build(spark, sources, folder, layers=["staging"], years=(Y0, Y1))  # never written
    for layer in ("intermediate", "marts", "analytics"):
        house = build(spark, sources, folder, layers=[layer], years=(Y0, Y1))
    for name in ("anl_provider_withhold_risk", "anl_withhold_yoy", "anl_drug_spending"):
        ours, whole = (x.table(name).drop("_updated_at") for x in (house, data.house))
        assert ours.exceptAll(whole).count() == 0 and ours.count() == whole.count() > 0
