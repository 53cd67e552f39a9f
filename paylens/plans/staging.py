"""Raw text tables to typed, de-duplicated staging frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as k
from ..functions import columns as c
from ..operators.dedupe import latest_per_key, one_per_key


HIDDEN = ("_year_text", "source_loaded_at")  # needed up to the de-duplication only


def _renamed(names: dict[str, str]) -> list:
    return [F.col(f"`{raw}`").cast("string").alias(name) for raw, name in names.items()]


NEXT, NONE = "\u0001", "\u0002"  # between the texts of a row, and in place of a missing one


def dealt(typed: DataFrame, together: Callable[[DataFrame], DataFrame], apart: Sequence[str] = ("npi",)) -> DataFrame:
    """The rows as ``together`` shuffles them, with all text columns but those ``apart`` as one on the way: side by side, short
    texts take two to four times their length. A row that holds one of the two marks itself sends its texts as a list."""
    texts = [f.name for f in typed.schema.fields if f.dataType.typeName() == "string" and f.name not in apart]
    every = F.concat_ws("", *texts)
    marked = every.contains(NEXT) | every.contains(NONE)
    row = F.concat_ws(NEXT, *(F.coalesce(x, F.lit(NONE)) for x in texts))
    packed = typed.select(
        *(x for x in typed.columns if x not in texts),
        F.when(~marked, row).alias("_texts"), F.when(marked, F.array(*texts)).alias("_list"))
    parts = F.when(F.col("_list").isNull(), F.split("_texts", NEXT, -1))
    cut = together(packed).withColumn("_parts", parts)
    text = lambda i: F.coalesce(F.nullif(F.get("_parts", F.lit(i)), F.lit(NONE)), F.get("_list", F.lit(i)))
    return cut.select(*(text(texts.index(x)).alias(x) if x in texts else F.col(x) for x in typed.columns))


def _newest(typed: DataFrame, pair: tuple[str, str], together: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Newest load of each id.

    The id is a hash of npi, a pair of text columns and the year. The window runs on those
    natural columns, with the pair joined as the id joins it: the groups are those of the
    id, filters on ``npi`` and ``year`` still reach the scan, and the id itself is computed
    only for the rows that stay. ``_spot`` repeats the key as a number, so that the sort
    rarely has to look at the text (ids share their leading digits).

    ``together`` may shuffle the rows by some of the natural columns: the window then runs where they
    are, and a key sends all of its copies.
    """
    if together is not None:
        plain = F.col("year").cast("string")  # as the year's text mostly is: it is sent only where it differs
        typed = dealt(typed.withColumn("_year_text", F.nullif("_year_text", plain)), together)
        typed = typed.withColumn("_year_text", F.coalesce("_year_text", plain))
    first, second = (F.coalesce(F.col(x), F.lit("")) for x in pair)
    ties = [x for x in typed.columns if x not in ("npi", "year", *HIDDEN)]
    keyed = typed.withColumn("_pair", F.concat(first, F.lit("-"), second))
    keyed = keyed.withColumn("_spot", F.xxhash64("npi", "_pair", "year"))
    order = [F.col("source_loaded_at").desc_nulls_last()]
    return latest_per_key(keyed, ["_spot", "npi", "year", "_pair"], order, ties)


def stage_spending(raw: DataFrame, together: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Drug spending at provider x brand x generic x year."""
    typed = c.require_keys(raw, ["prscrbr_npi"]).select(
        *_renamed(k.SPENDING_TEXT),
        c.suppressed_int("tot_benes").alias("bene_count"),
        F.col("tot_clms").cast("int").alias("total_claim_count"),
        F.col("tot_day_suply").cast("int").alias("total_day_supply"),
        F.col("tot_drug_cst").cast(c.MONEY).alias("total_drug_cost"),
        F.col("year").cast("int").alias("year"),
        F.col("year").cast("string").alias("_year_text"),
        F.col("_loaded_at").cast("timestamp").alias("source_loaded_at"),
    )
    key = c.surrogate_key(["npi", "drug_name", "generic_name", "_year_text"])
    return _newest(typed, ("drug_name", "generic_name"), together).select(
        key.alias("spending_id"),
        *(x for x in typed.columns if x not in HIDDEN),
        F.current_timestamp().alias("_loaded_at"),
    )


def stage_utilization(raw: DataFrame, together: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Services at provider x procedure x place x year, with the implied withhold rate."""
    text = _renamed(k.UTILIZATION_TEXT)
    typed = c.require_keys(raw, ["rndrng_npi", "hcpcs_cd"]).select(
        *text[:3],
        F.lit(None).cast("string").alias("gender"),  # not in the source files any more
        *text[3:],
        F.col("tot_srvcs").cast(c.QUANTITY).alias("service_count"),
        F.col("tot_benes").cast("int").alias("unique_beneficiary_count"),
        F.col("tot_bene_day_srvcs").cast("int").alias("beneficiary_service_days"),
        F.col("avg_mdcr_alowd_amt").cast(c.MONEY).alias("avg_allowed_amount"),
        F.col("avg_sbmtd_chrg").cast(c.MONEY).alias("avg_submitted_charge"),
        F.col("avg_mdcr_pymt_amt").cast(c.MONEY).alias("avg_medicare_payment"),
        F.col("year").cast("int").alias("year"),
        F.col("year").cast("string").alias("_year_text"),
        F.col("_loaded_at").cast("timestamp").alias("source_loaded_at"),
    )
    key = c.surrogate_key(["npi", "hcpcs_code", "place_of_service", "_year_text"])
    rate = c.withhold_rate("avg_medicare_payment", "avg_allowed_amount")
    return _newest(typed, ("hcpcs_code", "place_of_service"), together).select(
        key.alias("utilization_id"),
        *(x for x in typed.columns if x not in (*HIDDEN, "year")),
        rate.alias("implied_withhold_rate"),
        "year",
        F.current_timestamp().alias("_loaded_at"),
    )


def stage_providers(raw: DataFrame) -> DataFrame:
    """Provider registry, one row per id. Of its 300+ columns only these are read."""
    typed = c.require_keys(raw, ["npi"]).select(
        *_renamed(k.REGISTRY_TEXT),
        F.coalesce(
            F.col(f"`{k.REGISTRY_ORG_LEGAL}`").cast("string"), F.col(k.REGISTRY_ORG_OTHER).cast("string")
        ).alias("org_name"),
    )
    ordered = ["npi", "entity_type", "org_name", *(x for x in typed.columns[2:] if x != "org_name")]
    return one_per_key(typed.select(*ordered), "npi").withColumn("_loaded_at", F.current_timestamp())
