from pyspark.sql import functions as F

from paylens import contracts as k
from paylens.operators.joins import hot_keys, lookup_join, salted_join
from paylens.plans import enrich


def facts(spark, n=3_000):
    """A third of the rows belong to key 0, some have no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(n).select("id", key.cast("string").alias("npi"))


def lookup(spark):
    return spark.range(40).select(F.col("id").cast("string").alias("npi"), (F.col("id") * 10).alias("v"))


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.select("id", "npi", "v").collect())


def test_hot_keys(spark):
    assert [r.npi for r in hot_keys(facts(spark), ["npi"], 0.2).collect()] == ["0"]


def test_salted_join_equals_plain_join(spark):
    for how in ("left", "inner"):
        plain = facts(spark).join(lookup(spark), "npi", how)
        salted = salted_join(facts(spark), lookup(spark), ["npi"], ["id"], how, share=0.01, salts=16)
        assert rows(salted) == rows(plain)


def test_hot_key_and_missing_keys_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        joined = salted_join(facts(spark, 30_000), lookup(spark), ["npi"], ["id"], share=0.2, salts=64)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 30_000 / 8 * 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_lookup_join_picks_by_size(spark):
    small = lookup_join(facts(spark), lookup(spark), ["npi"], ["id"])
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(facts(spark), lookup(spark), ["npi"], ["id"])
        assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
        assert rows(large) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_utilization_keeps_no_state_without_a_match(spark):
    columns = [x for x in k.UTILIZATION_COLUMNS if x not in (
        "cms_specialty", "primary_taxonomy_code", "entity_type_label", "provider_city", "provider_state")]
    staged = spark.range(1).select(F.lit("9").alias("npi"), *(F.lit("x").alias(x) for x in columns if x != "npi"),
                                   F.lit("S").alias("specialty"), F.lit("TX").alias("state"), F.lit("c").alias("city"))
    names = ("npi", "display_name", "city", "state", "primary_taxonomy_code", "entity_type_label")
    provider = spark.createDataFrame([("1", "N", "C", "CA", "T", "individual")], ", ".join(f"{x} string" for x in names))
    row = enrich.enrich_utilization(staged, provider).first()
    assert (row.provider_state, row.provider_city, row.provider_name, row.cms_specialty) == (None, None, "x", "S")
