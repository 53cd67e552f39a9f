"""Fixed values of the data contract: raw column names, table names, checks and caps.

They must equal the published source files and the tables that existing reports read, so
they are kept together here as plain text.
"""

# Raw column -> staged column, by raw table ---------------------------------------------
SPENDING_TEXT = {
    "prscrbr_npi": "npi",
    "prscrbr_last_org_name": "provider_name",
    "prscrbr_first_name": "provider_first_name",
    "prscrbr_city": "provider_city",
    "prscrbr_state_abrvtn": "provider_state",
    "prscrbr_type": "specialty",
    "brnd_name": "drug_name",
    "gnrc_name": "generic_name",
}

UTILIZATION_TEXT = {
    "rndrng_npi": "npi",
    "rndrng_prvdr_last_org_name": "provider_name",
    "rndrng_prvdr_crdntls": "credentials",
    "rndrng_prvdr_ent_cd": "entity_type",
    "rndrng_prvdr_city": "city",
    "rndrng_prvdr_state_abrvtn": "state",
    "rndrng_prvdr_type": "specialty",
    "rndrng_prvdr_mdcr_prtcptg_ind": "medicare_participating",
    "hcpcs_cd": "hcpcs_code",
    "hcpcs_desc": "hcpcs_description",
    "hcpcs_drug_ind": "is_drug_service",
    "place_of_srvc": "place_of_service",
}

REGISTRY_TEXT = {
    "npi": "npi",
    "entity_type_code": "entity_type",
    "provider_last_name_(legal_name)": "last_name",
    "provider_first_name": "first_name",
    "provider_credential_text": "credentials",
    "provider_business_practice_location_address_city_name": "city",
    "provider_business_practice_location_address_state_name": "state",
    "provider_business_practice_location_address_postal_code": "zip",
    "healthcare_provider_taxonomy_code_1": "primary_taxonomy_code",
    "is_sole_proprietor": "is_sole_proprietor",
}
REGISTRY_ORG_LEGAL = "provider_organization_name_(legal_business_name)"
REGISTRY_ORG_OTHER = "provider_other_organization_name"

# Files: full-match pattern on the stem -> table ----------------------------------------
FILE_ROUTES = {
    r"cms_part_d_spending_\d{4}": "cms_part_d_spending",
    r"cms_provider_utilization_\d{4}": "cms_provider_utilization",
    r"nppes_providers": "nppes_providers",
}

# Raw quality checks --------------------------------------------------------------------
RAW_CHECKS = {
    "cms_part_d_spending": {
        "required": ["prscrbr_npi", "year", "tot_clms", "tot_drug_cst"],
        "not_null": ["prscrbr_npi", "year"],
        "id": "prscrbr_npi",
        "year": "year",
    },
    "cms_provider_utilization": {
        "required": ["rndrng_npi", "hcpcs_cd", "year", "avg_mdcr_pymt_amt", "avg_mdcr_alowd_amt"],
        "not_null": ["rndrng_npi", "hcpcs_cd", "year"],
        "id": "rndrng_npi",
        "year": "year",
        "ratio": ("avg_mdcr_pymt_amt", "avg_mdcr_alowd_amt"),
    },
    "nppes_providers": {"required": ["npi"], "not_null": ["npi"], "id": "npi"},
}
CHECKED_YEARS = (2023, 2024)
ID_PATTERN = r"^\d{10}$"
NOT_NULL_STRICT, NOT_NULL_NORMAL = 0.99, 0.91
YEARS_STRICT, YEARS_NORMAL = 0.99, 0.95
RATIO_STRICT, RATIO_NORMAL = 0.95, 0.80
RATIO_RANGE = (0.0, 1.10)
ID_RATE = 0.95
SAMPLE_FRACTION = 0.01

# Column contracts per layer: table -> (unique columns, not-null columns) -----------------
CONTRACTS = {
    "staging": {
        "stg_cms_part_d_spending": (["spending_id"], ["spending_id", "npi", "total_claim_count"]),
        "stg_cms_provider_utilization": (["utilization_id"], ["utilization_id", "npi", "hcpcs_code"]),
        "stg_nppes_providers": (["npi"], ["npi"]),
    },
    "intermediate": {
        "int_providers": (["npi"], ["npi"]),
        "int_utilization_enriched": (["utilization_id"], ["utilization_id", "npi"]),
        "int_spending_enriched": (["spending_id"], ["spending_id", "npi"]),
    },
    "marts": {
        "dim_providers": (["npi"], ["npi", "display_name"]),
        "fct_provider_spending": (["spending_id"], ["spending_id", "npi"]),
        "fct_utilization_by_specialty": (
            ["specialty_benchmark_id"],
            ["specialty_benchmark_id", "specialty", "year"],
        ),
    },
    "analytics": {
        "anl_kpi_overview": ([], ["provider_count"]),
        "anl_withhold_national": ([], ["specialty", "year"]),
        "anl_withhold_by_state": ([], ["state", "year"]),
        "anl_withhold_yoy": (["specialty"], ["specialty"]),
        "anl_drug_spending": ([], ["drug_name", "year"]),
        "anl_provider_withhold_risk": (["provider_risk_id"], ["provider_risk_id", "npi"]),
    },
}
LAYERS = ("staging", "intermediate", "marts", "analytics")

# Columns of the built tables and reports, fixed by what reads them -------------------------
DIM_COLUMNS = (
    "npi", "entity_type", "entity_type_label", "display_name", "org_name", "last_name", "first_name",
    "credentials", "city", "state", "zip", "primary_taxonomy_code", "is_sole_proprietor", "_updated_at",
)
SPENDING_COLUMNS = (
    "spending_id", "npi", "provider_name", "provider_city", "provider_state",
    "provider_taxonomy_or_specialty", "entity_type_label", "drug_name", "generic_name", "bene_count",
    "total_claim_count", "total_day_supply", "total_drug_cost", "year", "_loaded_at",
)
UTILIZATION_COLUMNS = (
    "utilization_id", "npi", "provider_name", "cms_specialty", "primary_taxonomy_code",
    "entity_type_label", "provider_city", "provider_state", "credentials", "medicare_participating",
    "hcpcs_code", "hcpcs_description", "is_drug_service", "place_of_service", "service_count",
    "unique_beneficiary_count", "beneficiary_service_days", "avg_allowed_amount",
    "avg_submitted_charge", "avg_medicare_payment", "implied_withhold_rate", "year", "_loaded_at",
)
CARD = (
    "npi", "display_name", "entity_type_label", "city", "state", "primary_taxonomy_code", "credentials",
)
RUN_SCHEMA = (
    "run_id string, pipeline_name string, status string, started_at timestamp, finished_at timestamp, "
    "steps array<struct<name:string,status:string,duration_sec:double,detail:string>>, "
    "error_message string, triggered_by string, recorded_at timestamp"
)
RUN_STATUSES = ("running", "success", "failed")

# Export and publishing -----------------------------------------------------------------
EXPORT_TABLES = tuple(CONTRACTS["analytics"])
EXPORT_STRATA = {"High": 100_000, "Low": 100_000}  # for a thinned export, if one is asked for
PUBLISH_TABLES = (
    *EXPORT_TABLES, "fct_utilization_by_specialty", "dim_providers", "int_utilization_enriched",
)
PUBLISH_CAPS = {  # for a small target database, if it is asked for
    "anl_provider_withhold_risk": 200_000,
    "dim_providers": 500_000,
    "int_utilization_enriched": 1_000_000,
}

# Classifier ----------------------------------------------------------------------------
CATEGORICAL = ("cms_specialty", "provider_state")
NUMERIC = (
    "year", "service_line_count", "total_services", "avg_medicare_payment", "specialty_median_withhold",
)
FEATURES = (*CATEGORICAL, *NUMERIC)
GBT_PARAMS = {
    "maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8", "seed": 42,
}
MAX_CATEGORIES = 50
