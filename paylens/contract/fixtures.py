"""The given star-schema tables in the shape of the raw payment tables.

The mapping is SQL text that Spark and DuckDB read alike, so a query and its check start
from the same rows and every operator in between is compared. All raw columns are text.
Edge cases (missing specialty, suppressed counts, zero allowed amounts, blank names,
unmatched and repeated providers) are derived from the data by fixed rules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as k
from ..plans import enrich, marts, staging

Y0, Y1 = 1999, 2000  # the two full years that stand for "last year" and "this year"

UTILIZATION = """
select
  case when l_linenumber = 7 and l_quantity = 50 then ''
       else cast(2000000000 + l_suppkey as string) end as rndrng_npi,
  'Supplier ' || cast(l_suppkey as string) as rndrng_prvdr_last_org_name,
  case when l_suppkey % 3 = 0 then 'MD' end as rndrng_prvdr_crdntls,
  'O' as rndrng_prvdr_ent_cd,
  'City ' || cast(l_suppkey % 25 as string) as rndrng_prvdr_city,
  'Z' || cast(l_suppkey % 25 as string) as rndrng_prvdr_state_abrvtn,
  case when p_size > 1 then p_type end as rndrng_prvdr_type,
  case when l_suppkey % 5 = 0 then 'N' else 'Y' end as rndrng_prvdr_mdcr_prtcptg_ind,
  'H' || cast(l_partkey as string) as hcpcs_cd,
  p_name as hcpcs_desc,
  case when p_size > 40 then 'Y' else 'N' end as hcpcs_drug_ind,
  l_returnflag as place_of_srvc,
  cast(cast(l_quantity as decimal(18,1)) as string) as tot_srvcs,
  cast(cast(l_quantity as int) as string) as tot_benes,
  cast(l_linenumber as string) as tot_bene_day_srvcs,
  case when l_quantity = 1 then '0.00'
       else cast(cast(l_extendedprice * (1 + l_tax) + 0.000001 as decimal(18,2)) as string)
  end as avg_mdcr_alowd_amt,
  cast(cast(l_extendedprice as decimal(18,2)) as string) as avg_sbmtd_chrg,
  cast(cast(l_extendedprice * (1 - l_discount) + 0.000001 as decimal(18,2)) as string) as avg_mdcr_pymt_amt,
  cast(year(l_shipdate) as string) as year,
  l_shipdate as _loaded_at
from {lineitem} join {part} on l_partkey = p_partkey
"""

SPENDING = """
select
  cast(1000000000 + o_custkey as string) as prscrbr_npi,
  'Customer ' || cast(o_custkey as string) as prscrbr_last_org_name,
  case when o_custkey % 2 = 0 then 'Pat' end as prscrbr_first_name,
  'City ' || cast(o_custkey % 25 as string) as prscrbr_city,
  'Z' || cast(o_custkey % 25 as string) as prscrbr_state_abrvtn,
  'Type ' || cast(o_custkey % 9 as string) as prscrbr_type,
  case when p_size not in (2, 3) then p_brand end as brnd_name,
  case when p_size <> 3 then p_type end as gnrc_name,
  case when l_quantity < 11 then '*' when l_linenumber = 2 then '' when l_linenumber = 3 then 'NA'
       when l_linenumber <> 4 then cast(cast(l_quantity as int) as string) end as tot_benes,
  cast(l_linenumber as string) as tot_clms,
  cast(cast(l_quantity as int) * 30 as string) as tot_day_suply,
  cast(cast(l_extendedprice as decimal(18,2)) as string) as tot_drug_cst,
  cast(year(o_orderdate) as string) as year,
  l_shipdate as _loaded_at
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey
"""

# Rows of each id, near enough to tell which ids own very many, without the joins above.
UTILIZATION_SIZES = "select cast(2000000000 + l_suppkey as string) as npi from {lineitem}"
SPENDING_SIZES = """
select cast(1000000000 + o_custkey as string) as npi, rows
from {orders} join (select l_orderkey, count(*) as rows from {lineitem} group by l_orderkey) on l_orderkey = o_orderkey
"""

# Suppliers are organisations, customers are persons; those with a balance of 0 or less are
# registered under an id that no payment has, and every fourth customer is there twice.
CUSTOMERS = """
select cast(case when c_acctbal > 0 then 1000000000 else 7000000000 end + c_custkey as string),
  case when c_custkey % 50 = 0 then '9' else '1' end,
  cast(null as string), cast(null as string),
  case when c_custkey % 5 <> 0 then split_part(c_name, '#', 2) end,
  case when c_custkey % 7 <> 0 then split_part(c_name, '#', 1) end,
  c_mktsegment,
  case when c_custkey % 6 <> 0 then 'Town ' || cast(c_nationkey as string) end,
  case when c_custkey % 11 <> 0 then 'S' || cast(c_nationkey as string) end,
  cast(20000 + c_custkey * {copy} as string),
  case when c_custkey % 4 <> 0 then 'TX' || cast(c_custkey % 20 as string) end, 'Y'
from {customer} where true"""
REGISTRY = f"""
select cast(case when s_acctbal > 0 then 2000000000 else 8000000000 end + s_suppkey as string) as npi, '2' as entity_type_code,
  case when s_suppkey % 10 = 0 then '  ' when s_suppkey % 10 <> 1 then s_name end as org_legal_name,
  s_name || ' (other)' as provider_other_organization_name,
  cast(null as string) as last_name, cast(null as string) as first_name,
  cast(null as string) as credential,
  'Town ' || cast(s_nationkey as string) as city,
  case when s_suppkey % 11 <> 0 then 'S' || cast(s_nationkey as string) end as state,
  cast(10000 + s_suppkey as string) as zip,
  'TX' || cast(s_suppkey % 20 as string) as taxonomy, 'N' as is_sole_proprietor
from {{supplier}}
union all {CUSTOMERS.replace("{copy}", "1")}
union all {CUSTOMERS.replace("{copy}", "2")} and c_custkey % 4 = 0
"""

REGISTRY_HEADERS = {
    "org_legal_name": k.REGISTRY_ORG_LEGAL,
    "last_name": "provider_last_name_(legal_name)",
    "first_name": "provider_first_name",
    "credential": "provider_credential_text",
    "city": "provider_business_practice_location_address_city_name",
    "state": "provider_business_practice_location_address_state_name",
    "zip": "provider_business_practice_location_address_postal_code",
    "taxonomy": "healthcare_provider_taxonomy_code_1",
}

# Line items on their way to the tables they are joined to: bits that a value takes in a number of 64. Half of the shuffles that
# read the facts is less than half of the bytes in this form; a row with a value that does not fit, or none, sends its values as they are.
BITS = ({"l_shipdate": 16, "l_linenumber": 4, "l_quantity": 16, "l_extendedprice": 27}, {"l_suppkey": 31, "l_discount": 8, "l_tax": 8})


def _code(name: str, kind: str) -> tuple[Column, Column]:
    """A value as a whole number, and whether it can be had back from that."""
    x = F.col(name)
    if kind == "double":  # hundredths
        code = F.floor(x * 100 + 0.5)
        return code, code / F.lit(100.0) == x
    if kind == "timestamp_ntz":  # days
        code = F.unix_date(x.cast("date")).cast("bigint")
        return code, x.cast("date").cast("timestamp_ntz") == x
    return x.cast("bigint"), F.lit(True)


def _value(code: Column, kind: str) -> Column:
    if kind == "double":
        return code / F.lit(100.0)
    if kind == "timestamp_ntz":
        return F.date_from_unix_date(code.cast("int")).cast("timestamp_ntz")
    return code.cast(kind)


def joined_packed(lines: DataFrame, names: Sequence[str], join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``join`` of the line items, whose columns ``names`` are a few whole numbers up to there."""
    kinds = dict(lines.dtypes)
    fit = {x for x in names if kinds.get(x) in ("int", "bigint", "double", "timestamp_ntz")}
    groups = [found for group in BITS if (found := {x: bits for x, bits in group.items() if x in fit})]
    codes = {x: _code(x, kinds[x]) for group in groups for x in group}
    held = F.spark_partition_id() >= 0  # always so; it keeps filters from being moved, with all of this in them, below the packing
    for group in groups:
        for x, bits in group.items():
            held = held & F.coalesce(codes[x][1] & codes[x][0].between(0, (1 << bits) - 1), F.lit(False))
    packed, plain = [], []
    for i, group in enumerate(groups):
        number, at = F.lit(0).cast("bigint"), 0
        for x, bits in group.items():
            number = number.bitwiseOR(F.shiftleft(codes[x][0], at))
            code = F.shiftright(F.col(f"_packed_{i}"), at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
            plain.append(F.when(F.col("_plain").isNull(), _value(code, kinds[x])).otherwise(F.col(f"_plain.{x}")).alias(x))
            at += bits
        packed.append(F.when(F.col("_held"), number).alias(f"_packed_{i}"))
    rest = [x for x in lines.columns if x not in codes]
    sent = lines.withColumn("_held", held).select(*rest, *packed, F.when(~F.col("_held"), F.struct(*codes)).alias("_plain"))
    whole = join(sent)
    return whole.select(*(x for x in whole.columns if x not in ("_plain", *(f"_packed_{i}" for i in range(len(groups))))), *plain)


class Tables:
    """Lazy frames of every layer over one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def sql(self, text: str, *names: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **{n: self.given(n) for n in names}, **frames)

    def _lines(self, text: str, *others: str) -> DataFrame:
        """A mapping of line items; they are packed on their way through its joins, which follow ``others``."""
        head, source = text.split("\nfrom ")
        lines, tables = self.given("lineitem"), {x: self.given(x) for x in others}
        if "orders" in tables:  # only its year is used, which a day has as well
            tables["orders"] = tables["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        used = {x for x in (y for frame in (lines, *tables.values()) for y in frame.columns) if re.search(rf"\b{x}\b", text)}

        def join(sent: DataFrame) -> DataFrame:
            return self.spark.sql(f"select * from {source}", lineitem=sent, **{x: t.select(*(y for y in t.columns if y in used)) for x, t in tables.items()})

        lines = lines.select(*(x for x in lines.columns if x in used))
        return self.spark.sql(f"{head}\nfrom {{lines}}", lines=joined_packed(lines, sorted(used), join))

    def raw_utilization(self) -> DataFrame:
        return self._lines(UTILIZATION, "part")

    def raw_spending(self) -> DataFrame:
        return self._lines(SPENDING, "orders", "part")

    def raw_registry(self) -> DataFrame:
        return self.sql(REGISTRY, "supplier", "customer").withColumnsRenamed(REGISTRY_HEADERS)

    def utilization_sizes(self) -> DataFrame:
        return self.sql(UTILIZATION_SIZES, "lineitem")

    def spending_sizes(self) -> DataFrame:
        return self.sql(SPENDING_SIZES, "orders", "lineitem")

    def staged_utilization(self) -> DataFrame:
        return staging.stage_utilization(self.raw_utilization())

    def staged_spending(self) -> DataFrame:
        return staging.stage_spending(self.raw_spending())

    def staged_providers(self) -> DataFrame:
        return staging.stage_providers(self.raw_registry())

    def providers(self) -> DataFrame:
        return enrich.providers(self.staged_providers())

    def dim(self) -> DataFrame:
        return enrich.dim_providers(self.providers())

    def utilization(self) -> DataFrame:
        return enrich.utilization(self.raw_utilization(), self.providers(), self.utilization_sizes())

    def spending(self) -> DataFrame:
        return enrich.spending(self.raw_spending(), self.providers(), self.spending_sizes())

    def fact(self) -> DataFrame:
        return enrich.fct_provider_spending(self.spending())

    def benchmark(self) -> DataFrame:
        return marts.specialty_benchmark(self.utilization())

    def national(self) -> DataFrame:
        return marts.national_benchmark(self.benchmark())

    def states(self) -> DataFrame:
        return marts.state_benchmark(self.benchmark())

    def yoy(self) -> DataFrame:
        return marts.year_over_year(self.national(), Y0, Y1)

    def drugs(self) -> DataFrame:
        return marts.drug_spending(self.fact())

    def risk(self) -> DataFrame:
        return marts.provider_risk(self.utilization(), self.benchmark())

    def kpi(self) -> DataFrame:
        return marts.kpi_overview(self.dim(), self.benchmark(), self.fact())
