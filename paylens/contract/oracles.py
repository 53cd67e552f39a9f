"""DuckDB SQL that computes the same results as the registered queries, on its own.

``CTES`` holds one definition per layer; :func:`sql` puts the needed ones in front of a
query. Rounding: a double is first cut to 14 decimals, so that a value half-way between
two results rounds up as exact decimal arithmetic does.
"""

from __future__ import annotations

import re

from .. import contracts as k
from . import fixtures as fx

Y0, Y1 = fx.Y0, fx.Y1


def rounded(x: str, places: int, type_: str | None = None, cut: int = 14) -> str:
    return f"cast(round(cast({x} as decimal(38,{cut})), {places}) as {type_ or f'decimal(24,{places})'})"


def mean(x: str, places: int, type_: str | None = None) -> str:
    cut = 8 if type_ else 14  # a double of an amount has fewer exact decimals than one of a rate
    return rounded(f"cast(sum({x}) as double) / nullif(count({x}), 0)", places, type_, cut)


def weighted(x: str, w: str) -> str:
    return rounded(f"cast(sum(cast({x} as decimal(18,4)) * {w}) as double) / nullif(sum({w}), 0)", 4)


MONEY = "decimal(23,2)"

CTES = {
    "raw_u": fx.UTILIZATION.format(lineitem="lineitem", part="part"),
    "raw_s": fx.SPENDING.format(lineitem="lineitem", orders="orders", part="part"),
    "raw_r": fx.REGISTRY.format(supplier="supplier", customer="customer"),
    "stg_u": f"""
        select md5(npi || '-' || hcpcs_code || '-' || coalesce(place_of_service, '') || '-' || coalesce(y, ''))
                 as utilization_id,
               * exclude (y, loaded, year),
               {rounded("1.0 - cast(avg_medicare_payment as double) / nullif(cast(avg_allowed_amount as double), 0)", 4)}
                 as implied_withhold_rate,
               year
        from (
          select rndrng_npi as npi, rndrng_prvdr_last_org_name as provider_name,
            rndrng_prvdr_crdntls as credentials, cast(null as varchar) as gender,
            rndrng_prvdr_ent_cd as entity_type, rndrng_prvdr_city as city,
            rndrng_prvdr_state_abrvtn as state, rndrng_prvdr_type as specialty,
            rndrng_prvdr_mdcr_prtcptg_ind as medicare_participating, hcpcs_cd as hcpcs_code,
            hcpcs_desc as hcpcs_description, hcpcs_drug_ind as is_drug_service,
            place_of_srvc as place_of_service, cast(tot_srvcs as decimal(18,4)) as service_count,
            cast(tot_benes as int) as unique_beneficiary_count,
            cast(tot_bene_day_srvcs as int) as beneficiary_service_days,
            cast(avg_mdcr_alowd_amt as decimal(18,2)) as avg_allowed_amount,
            cast(avg_sbmtd_chrg as decimal(18,2)) as avg_submitted_charge,
            cast(avg_mdcr_pymt_amt as decimal(18,2)) as avg_medicare_payment,
            cast(year as int) as year, year as y, _loaded_at as loaded
          from raw_u where rndrng_npi <> '' and hcpcs_cd <> '')
        qualify row_number() over (
          partition by npi, hcpcs_code, place_of_service, y
          order by loaded desc nulls last, provider_name nulls last, credentials nulls last,
            city nulls last, state nulls last, specialty nulls last, medicare_participating nulls last,
            hcpcs_description nulls last, is_drug_service nulls last, service_count nulls last,
            unique_beneficiary_count nulls last, beneficiary_service_days nulls last,
            avg_allowed_amount nulls last, avg_submitted_charge nulls last,
            avg_medicare_payment nulls last) = 1""",
    "stg_s": """
        select md5(npi || '-' || coalesce(drug_name, '') || '-' || coalesce(generic_name, '') || '-' || coalesce(y, ''))
                 as spending_id, * exclude (y, loaded)
        from (
          select prscrbr_npi as npi, prscrbr_last_org_name as provider_name,
            prscrbr_first_name as provider_first_name, prscrbr_city as provider_city,
            prscrbr_state_abrvtn as provider_state, prscrbr_type as specialty,
            brnd_name as drug_name, gnrc_name as generic_name,
            cast(case when tot_benes not in ('', '*', 'NA') then tot_benes end as int) as bene_count,
            cast(tot_clms as int) as total_claim_count, cast(tot_day_suply as int) as total_day_supply,
            cast(tot_drug_cst as decimal(18,2)) as total_drug_cost,
            cast(year as int) as year, year as y, _loaded_at as loaded
          from raw_s where prscrbr_npi <> '')
        qualify row_number() over (
          partition by npi, coalesce(drug_name, '') || '-' || coalesce(generic_name, ''), y
          order by loaded desc nulls last, provider_name nulls last, provider_first_name nulls last,
            provider_city nulls last, provider_state nulls last, specialty nulls last, drug_name nulls last,
            generic_name nulls last, bene_count nulls last, total_claim_count nulls last,
            total_day_supply nulls last, total_drug_cost nulls last) = 1""",
    "stg_p": """
        select npi, entity_type_code as entity_type,
          coalesce(org_legal_name, provider_other_organization_name) as org_name,
          last_name, first_name, credential as credentials, city, state, zip,
          taxonomy as primary_taxonomy_code, is_sole_proprietor
        from raw_r where npi <> ''
        qualify row_number() over (partition by npi order by entity_type nulls last, org_name nulls last,
          last_name nulls last, first_name nulls last, credential nulls last, city nulls last, state nulls last,
          zip nulls last, taxonomy nulls last, is_sole_proprietor nulls last) = 1""",
    "prov": """
        select *,
          coalesce(nullif(trim(if(entity_type = '2', org_name, concat(first_name, ' ', last_name))), ''), npi)
            as display_name,
          case entity_type when '2' then 'organization' when '1' then 'individual' else 'unknown' end
            as entity_type_label
        from stg_p""",
    "util": """
        select u.utilization_id, u.npi, coalesce(p.display_name, u.provider_name) as provider_name,
          u.specialty as cms_specialty, p.primary_taxonomy_code, p.entity_type_label,
          p.city as provider_city, p.state as provider_state, u.credentials, u.medicare_participating,
          u.hcpcs_code, u.hcpcs_description, u.is_drug_service, u.place_of_service, u.service_count,
          u.unique_beneficiary_count, u.beneficiary_service_days, u.avg_allowed_amount,
          u.avg_submitted_charge, u.avg_medicare_payment, u.implied_withhold_rate, u.year
        from stg_u u left join prov p using (npi)""",
    "spend": """
        select s.spending_id, s.npi, coalesce(p.display_name, s.provider_name) as provider_name,
          coalesce(p.city, s.provider_city) as provider_city,
          coalesce(p.state, s.provider_state) as provider_state,
          coalesce(p.primary_taxonomy_code, s.specialty) as provider_taxonomy_or_specialty,
          p.entity_type_label, s.drug_name, s.generic_name, s.bene_count, s.total_claim_count,
          s.total_day_supply, s.total_drug_cost, s.year
        from stg_s s left join prov p using (npi)""",
    "bench": f"""
        select md5(specialty || '-' || state || '-' || coalesce(cast(year as varchar), '')) as specialty_benchmark_id, *
        from (
          select coalesce(cms_specialty, 'Unknown') as specialty, coalesce(provider_state, 'Unknown') as state, year,
            count(distinct npi) as provider_count, count(*) as service_line_count,
            cast(sum(service_count) as decimal(28,4)) as total_services,
            cast(sum(unique_beneficiary_count) as bigint) as total_beneficiaries,
            {mean("avg_allowed_amount", 2, MONEY)} as avg_allowed_amount,
            {mean("avg_medicare_payment", 2, MONEY)} as avg_medicare_payment,
            {mean("implied_withhold_rate", 4)} as avg_withhold_rate,
            {rounded("quantile_cont(cast(implied_withhold_rate as double), 0.5)", 4)} as median_withhold_rate,
            max(implied_withhold_rate) as max_withhold_rate
          from util where implied_withhold_rate is not null group by all)""",
    "nat": f"""
        select specialty, year, cast(sum(provider_count) as bigint) as provider_count,
          cast(sum(service_line_count) as bigint) as service_line_count,
          cast(sum(total_services) as decimal(38,4)) as total_services,
          cast(sum(total_beneficiaries) as bigint) as total_beneficiaries,
          {weighted("avg_withhold_rate", "provider_count")} as weighted_avg_withhold_rate,
          {mean("median_withhold_rate", 4)} as avg_median_withhold_rate,
          max(max_withhold_rate) as max_withhold_rate
        from bench where specialty <> 'Unknown' group by specialty, year""",
    "st": f"""
        select state, year, count(distinct specialty) as specialty_count,
          cast(sum(provider_count) as bigint) as provider_count,
          cast(sum(total_services) as decimal(38,4)) as total_services,
          {weighted("avg_withhold_rate", "provider_count")} as weighted_avg_withhold_rate,
          {mean("median_withhold_rate", 4)} as avg_median_withhold_rate
        from bench where state <> 'Unknown' group by state, year""",
    "yoy": f"""
        select a.specialty, a.weighted_avg_withhold_rate as withhold_rate_{Y0},
          b.weighted_avg_withhold_rate as withhold_rate_{Y1},
          cast(b.weighted_avg_withhold_rate - a.weighted_avg_withhold_rate as decimal(24,4)) as withhold_rate_change,
          {rounded("cast(b.weighted_avg_withhold_rate - a.weighted_avg_withhold_rate as double) / nullif(cast(a.weighted_avg_withhold_rate as double), 0)", 4)}
            as withhold_rate_pct_change,
          a.total_services as total_services_{Y0}, b.total_services as total_services_{Y1},
          cast(b.total_services - a.total_services as decimal(38,4)) as service_volume_change
        from nat a join nat b on a.specialty = b.specialty and a.year = {Y0} and b.year = {Y1}
        where a.weighted_avg_withhold_rate is not null and b.weighted_avg_withhold_rate is not null""",
    "drugs": f"""
        select coalesce(drug_name, generic_name, 'Unknown') as drug_name, generic_name, year,
          count(distinct npi) as prescriber_count, cast(sum(total_claim_count) as bigint) as total_claims,
          cast(sum(total_day_supply) as bigint) as total_day_supply,
          cast(sum(total_drug_cost) as decimal(28,2)) as total_medicare_cost,
          {mean("total_drug_cost", 2, MONEY)} as avg_cost_per_row
        from spend where coalesce(drug_name, generic_name) is not null group by 1, 2, 3""",
    "pyear": f"""
        select npi, max(provider_name) as provider_name, cms_specialty, provider_state, year,
          {mean("implied_withhold_rate", 4)} as avg_withhold_rate, count(*) as service_line_count,
          cast(sum(service_count) as decimal(28,4)) as total_services,
          {mean("avg_medicare_payment", 2, MONEY)} as avg_medicare_payment
        from util where implied_withhold_rate is not null and cms_specialty is not null
        group by npi, cms_specialty, provider_state, year having count(*) >= 5""",
    "med": f"""
        select specialty as cms_specialty, year,
          {weighted("median_withhold_rate", "provider_count")} as specialty_median_withhold
        from bench where specialty <> 'Unknown' group by 1, 2""",
    "risk": """
        select md5(npi || '-' || cms_specialty || '-' || coalesce(provider_state, '') || '-' || cast(year as varchar))
            as provider_risk_id,
          npi, provider_name, cms_specialty, provider_state, year, avg_withhold_rate, specialty_median_withhold,
          cast(avg_withhold_rate - specialty_median_withhold as decimal(24,4)) as withhold_vs_median,
          case sign(avg_withhold_rate - specialty_median_withhold) when 1 then 'High' when -1 then 'Low'
            else 'At Median' end as withhold_risk_band,
          service_line_count, total_services, avg_medicare_payment
        from pyear join med using (cms_specialty, year)""",
    "kpi": f"""
        select (select count(*) from prov) as provider_count, (select count(*) from bench) as benchmark_row_count,
          (select {mean("avg_withhold_rate", 4)} from bench where specialty <> 'Unknown') as national_avg_withhold_rate,
          (select {mean("median_withhold_rate", 4)} from bench where specialty <> 'Unknown')
            as national_median_withhold_rate,
          (select cast(sum(total_drug_cost) as decimal(28,2)) from spend) as total_part_d_cost,
          (select count(distinct npi) from spend) as part_d_prescriber_count,
          (select count(distinct drug_name) from spend) as distinct_drugs""",
    "train": f"""
        select provider_risk_id, cms_specialty, provider_state, year, service_line_count, total_services,
          avg_medicare_payment, specialty_median_withhold,
          cast(withhold_risk_band = 'High' as int) as is_high_risk
        from risk where year in ({Y0}, {Y1}) and withhold_risk_band <> 'At Median'""",
    # a fixed score column, so that the metrics have an oracle without a fitted model
    "scored": """
        select provider_risk_id, is_high_risk, cast(service_line_count % 17 as double) / 32 as score,
          cast(service_line_count % 17 >= 8 as int) as prediction
        from train""",
}


def sql(query: str) -> str:
    """Put the definitions a query needs, and theirs, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(query)
    parts = [f"{name} as materialized ({CTES[name]})" for name in needed]
    return (f"with {', '.join(parts)} " if parts else "") + query


def top(query: str, by: str, n: int, *ties: str) -> str:
    order = ", ".join([f"{by} desc nulls last", *(f"{t} nulls last" for t in ties)])
    return f"{query} order by {order} limit {n}"


TOKENS = """'', 'NA', 'N/A', 'NULL', 'null', 'None', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
  '1.#IND', '1.#QNAN', '<NA>', 'NaN', 'n/a', 'nan'"""
RATE_MEAN = "cast(sum({0}) as double) / nullif(count({0}), 0)"
CARD = "npi, display_name, entity_type_label, city, state, primary_taxonomy_code, credentials"


def nullish(x: str) -> str:
    return f"({x} is null or trim({x}) = '' or lower(trim({x})) in ('nan', 'none', 'null', '<na>'))"


def check_row(table: str, check: str, rate: str, need: float, severity: str = "error", unmeasured: str | None = None) -> str:
    return f"""select '{table}' as "table", '{check}' as "check", coalesce(rate >= {need!r}, false) as passed,
        case when rate is null then '{unmeasured or severity}' else '{severity}' end as severity, rate, cast({need!r} as double) as threshold from (select {rate} as rate from raw)"""


def share(condition: str) -> str:
    return f"coalesce(avg(cast(coalesce({condition}, false) as double)), 0)"


def utilization_checks(strict: bool) -> str:
    """The whole suite of the utilization table."""
    t = "cms_provider_utilization"
    a, p = "try_cast(avg_mdcr_alowd_amt as double)", "try_cast(avg_mdcr_pymt_amt as double)"
    rows = [
        check_row(t, "row_count", "case when count(*) > 0 then 1.0e0 else 0.0e0 end", 1.0),
        check_row(t, "required_columns", "1.0e0 + 0 * count(*)", 1.0),
        *(
            check_row(t, f"not_null:{x}", share(f"not {nullish(x)}"), 0.99 if strict else 0.91)
            for x in ("rndrng_npi", "hcpcs_cd", "year")
        ),
        check_row(t, "payment_amounts",
                  f"avg(case when {a} > 0 and {p} is not null then cast({p} / {a} between 0 and 1.10 as double) end)",
                  0.95 if strict else 0.80, "error" if strict else "warn", "warn"),
        check_row(t, "npi_format:rndrng_npi", id_rate("rndrng_npi"), 0.95, "warn", "error"),
        check_row(t, f"years_{Y0}_{Y1}", share(f"try_cast(year as double) in ({Y0}, {Y1})"), 0.99 if strict else 0.95),
    ]
    return sql("select * from (" + " union all ".join(rows).replace("from raw)", "from raw_u)") + ")")


def id_rate(x: str, pattern: str = r"\d{10}") -> str:
    clean = f"regexp_replace(trim({x}), '\\.0$', '')"
    return f"avg(case when not {nullish(x)} then cast(regexp_full_match({clean}, '{pattern}') as double) end)"
