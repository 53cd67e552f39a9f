"""Column expressions shared by the layers. All are JVM-side; there are no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------------------
# Text that a yearly file uses for "no value" (the loader's own tokens, then the default
# missing-value tokens of the pandas CSV reader).
NULL_TOKENS = (
    "", "NA", "N/A", "NULL", "null", "None",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "NaN", "n/a", "nan",
)
# Text that stands for a suppressed count.
SUPPRESSED = ("", "*", "NA")
# Text that the quality checks count as missing, compared in lower case.
NULLISH_WORDS = ("nan", "none", "null", "<na>")
ENTITY_LABELS = {"2": "organization", "1": "individual"}
ENTITY_OTHER = "unknown"
UNKNOWN = "Unknown"
# --------------------------------------------------------------------------------------

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim; an empty result is null."""
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def suppressed_int(c: Column | str, tokens: Sequence[str] = SUPPRESSED) -> Column:
    """Count in text: a suppression token gives null, any other non-number raises (ANSI)."""
    c = as_column(c)
    return F.when(~c.isin(*tokens), c).cast("int")


def surrogate_key(parts: Iterable[Column | str], strict: Iterable[str] = ()) -> Column:
    """MD5 of the parts joined by ``-``. A null part counts as empty text, except parts
    named in ``strict``: a null there makes the whole key null."""
    strict = set(strict)
    pieces: list[Column] = []
    for part in parts:
        text = as_column(part).cast("string")
        if not (isinstance(part, str) and part in strict):
            text = F.coalesce(text, F.lit(""))
        pieces += [F.lit("-"), text]
    return F.md5(F.concat(*pieces[1:]))


def withhold_rate(paid: Column | str, allowed: Column | str) -> Column:
    """Share of the allowed amount that was not paid, 4 places; null if nothing was allowed."""
    allowed = as_column(allowed)
    return F.round(F.lit(1) - as_column(paid) / F.nullif(allowed, F.lit(0).cast(MONEY)), 4)


def exact_ratio(total: Column, weight: Column, places: int, scale: int) -> Column:
    """``total / weight`` rounded half-up once. Both operands are narrowed so that the
    quotient keeps about 20 decimals; the default result type of a long sum divided by a
    bigint keeps as few as 6 and would round twice. A zero weight gives null."""
    weight = F.nullif(weight, F.lit(0)).cast("decimal(15,0)")
    return F.round(total.cast(f"decimal(22,{scale})") / weight, places)


def exact_mean(value: Column | str, places: int, scale: int = 4) -> Column:
    """Mean of a decimal column. Decimal sums do not depend on the order of the rows."""
    value = as_column(value)
    return exact_ratio(F.sum(value), F.count(value), places, scale)


def weighted_mean(value: Column | str, weight: Column | str, places: int = 4) -> Column:
    """``sum(value*weight) / sum(weight)``, null when the weights add up to zero."""
    value, weight = as_column(value), as_column(weight)
    return exact_ratio(F.sum(value.cast("decimal(18,4)") * weight), F.sum(weight), places, 4)


def tidy_double(c: Column, places: int) -> Column:
    """Round a double half-up on its shortest decimal text, not on its binary value."""
    return F.round(c.cast("decimal(38,14)"), places).cast(f"decimal(24,{places})")


def exact_median(value: Column | str, weight: Column | None = None) -> Column:
    """Exact interpolated median as an aggregate (double). With ``weight`` the rows are a
    pre-counted histogram."""
    value = as_column(value)
    if weight is None:
        return F.percentile(value, F.lit(0.5))
    return F.percentile(value, F.lit(0.5), weight)


def approx_median(value: Column | str, accuracy: int = 10_000) -> Column:
    """Opt-in for columns with very many distinct values per group."""
    return F.percentile_approx(as_column(value), F.lit(0.5), F.lit(accuracy))


def display_name(entity: str, org: str, first: str, last: str, fallback: str) -> Column:
    """Organisation name for type 2, else "first last"; the id when that leaves nothing."""
    person = F.concat_ws(" ", F.coalesce(first, F.lit("")), F.coalesce(last, F.lit("")))
    name = F.when(F.col(entity) == "2", blank_to_null(org)).otherwise(blank_to_null(person))
    return F.coalesce(name, F.col(fallback))


def entity_label(entity: Column | str) -> Column:
    labels = F.lit(ENTITY_OTHER)
    for code, label in ENTITY_LABELS.items():
        labels = F.when(as_column(entity) == code, F.lit(label)).otherwise(labels)
    return labels


def or_unknown(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(UNKNOWN))


def known(c: str) -> Column:
    """Predicate that drops the bucket made by :func:`or_unknown`."""
    return F.col(c) != UNKNOWN


def short_label(c: Column | str, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


def first_known(preferred: str, fallback: str) -> Column:
    """Source priority: the first source's value, else the second's."""
    return F.coalesce(F.col(preferred), F.col(fallback))


def is_nullish(c: Column | str) -> Column:
    """Null, blank, or a word for "missing" in any letter case."""
    c = as_column(c).cast("string")
    return c.isNull() | (F.trim(c) == "") | F.lower(F.trim(c)).isin(*NULLISH_WORDS)


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are all present and not empty text."""
    for c in cols:
        df = df.filter(F.col(f"`{c}`") != "")  # a null comparison drops the row as well
    return df


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn every token into null in every text column."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")}
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        out.append(F.when(~c.isin(*tokens), c).alias(name) if name in text else c)
    return df.select(*out)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim, lower-case, and put ``_`` for each run of white space in the column names."""
    return df.toDF(*("_".join(name.lower().split()) for name in df.columns))
