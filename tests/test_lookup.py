import random

import pytest
from pyspark.sql import functions as F

from paylens import contracts as k
from paylens.plans import lookup
from paylens.plans.build import POINT_READS, Warehouse


def registry(spark, names):
    rows = [(f"{i:010d}", name) for i, name in enumerate(names)]
    frame = spark.createDataFrame(rows, "npi string, display_name string")
    return frame.select(*("npi" if x == "npi" else "display_name" if x == "display_name" else F.lit("x").alias(x) for x in k.CARD))


def names():
    rng = random.Random(5)
    made = [" ".join(rng.choice(["Ann", "Bo", "Åse", "Straße", "O'Hara", "Smith", "Smythe", "100%", "a_b"]) for _ in range(rng.randint(1, 3))) for _ in range(400)]
    return [*made, *made[:50], None, "", "x", "xy", "xyz", "XYZ Labs", " xy z", "aaaa", "İstanbul Health"]


@pytest.fixture
def indexed(spark, folder):
    dim = registry(spark, names())
    lookup.write_name_index(dim, folder)
    return dim, folder


def test_same_rows_as_a_scan(spark, indexed):
    dim, index = indexed
    for text in ("smith", "SMY", "åse", "straße", "o'hara", "100%", "a_b", "n b", "aaa", "aaaaa", "xyz", "xy", "x", "%", "nobody", " xy", "bo smith bo", "stanbul"):
        for n in (3, 500):
            got, want = lookup.indexed_by_name(dim, index, text, n), lookup.lookup_by_name(dim, text, n)
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], text


def test_search_takes_the_index(spark, indexed):
    dim, index = indexed
    for text in ("smith", "00000000", " ", None):
        assert lookup.lookup(dim, text, index=index).collect() == lookup.lookup(dim, text).collect()


def test_empty_registry(spark, folder):
    dim = registry(spark, ["x"]).limit(0)
    lookup.write_name_index(dim, folder)
    assert lookup.indexed_by_name(dim, folder, "smith").collect() == []


def read_by_scan(frame):
    """The rows, and how many rows the Parquet scans put out when they are collected."""
    rows = frame.collect()

    def scanned(plan):
        leaves = plan.collectLeaves()
        leaves = [leaves.apply(i) for i in range(leaves.size())]
        return sum(
            scanned(leaf.executedPlan()) if "AdaptiveSparkPlan" in leaf.nodeName()
            else scanned(leaf.plan()) if "QueryStage" in leaf.nodeName()
            else leaf.metrics().apply("numOutputRows").value() for leaf in leaves)

    return rows, scanned(frame._jdf.queryExecution().executedPlan())


def test_a_name_and_an_id_read_little(spark, folder):
    """A provider in a large registry: few row groups are read, told by the scan."""
    n = 120_000
    dim = spark.range(n).select(
        *((F.format_string("%010d", F.col("id") * 7919 % n)).alias(x) if x == "npi"
          else F.concat(F.lit("Clinic "), F.md5(F.col("id").cast("string"))).alias(x) if x == "display_name" else F.lit("x").alias(x) for x in k.CARD))
    small = {"parquet.block.size": str(256 << 10), "parquet.page.row.count.limit": "1000"}
    dim.repartitionByRange(4, "npi").sortWithinPartitions("npi").write.options(**POINT_READS, **small).parquet(f"{folder}/dim")
    written = spark.read.parquet(f"{folder}/dim")
    rows, seen = read_by_scan(written.filter("npi = '0000012345'").select("npi", "display_name"))
    assert len(rows) == 1 and seen <= 2_000
    lookup.write_name_index(written.filter("npi < '0000002000'"), f"{folder}/names")
    name = written.filter("npi = '0000001234'").first().display_name
    found = lookup.indexed_by_name(written, f"{folder}/names", name[7:])
    rows, seen = read_by_scan(found)
    assert [r.display_name for r in rows] == [name] and seen <= 2_000


def test_the_build_writes_the_index(spark, folder):
    house = Warehouse(spark, folder)
    registry(spark, ["Ann Smith", "Bo"]).write.parquet(f"{folder}/dim_providers")
    lookup.write_name_index(house.table("dim_providers"), house.name_index)
    assert [r.display_name for r in lookup.lookup(house.table("dim_providers"), "SMI", index=house.name_index).collect()] == ["Ann Smith"]
