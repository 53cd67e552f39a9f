"""The given tables in the shape of the raw ones."""

from datetime import datetime

from paylens.contract import fixtures as fx


def test_line_items_are_packed_through_their_joins(spark, folder):
    """The rows are those of the mapping as it stands, whatever the line items hold."""
    base = {"l_orderkey": 1, "l_partkey": 1, "l_suppkey": 7, "l_linenumber": 3, "l_quantity": 17.0, "l_extendedprice": 24710.35, "l_discount": 0.04,
            "l_tax": 0.02, "l_returnflag": "N", "l_linestatus": "O", "l_shipdate": datetime(1998, 2, 3)}
    odd = {"l_suppkey": [None, -1, 2**31, 2**40], "l_linenumber": [None, 0, 300, -5], "l_quantity": [None, 50.0, 0.125, -1.0, 1e6], "l_tax": [None, 9.5, 1 / 3],
           "l_extendedprice": [None, 0.0, 1e9, 0.005, -3.25], "l_discount": [None, 2.55, 2.56], "l_shipdate": [None, datetime(1960, 1, 1), datetime(2001, 2, 3, 4, 5, 6)]}
    rows = [base, {**base, "l_orderkey": None}, {**base, "l_partkey": None}, *({**base, x: v} for x, values in odd.items() for v in values)]
    kinds = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([tuple(r.values()) for r in rows], kinds).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("select 1L as p_partkey, 'a' as p_name, 'b' as p_brand, 'c' as p_type, 5 as p_size").write.parquet(f"{folder}/part.parquet")
    spark.sql("select 1L as o_orderkey, 9L as o_custkey, timestamp_ntz'1997-05-06' as o_orderdate").write.parquet(f"{folder}/orders.parquet")
    tables = fx.Tables(spark, folder)
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            for got, want in ((tables.raw_utilization(), tables.sql(fx.UTILIZATION, "lineitem", "part")),
                              (tables.raw_spending(), tables.sql(fx.SPENDING, "lineitem", "orders", "part"))):
                assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
                sent = got._jdf.queryExecution().optimizedPlan().toString()
                assert "_packed_0" in sent[sent.index("Join"):]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
