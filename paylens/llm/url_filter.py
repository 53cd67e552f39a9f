"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for all other URLs.

The trees are grown by Spark aggregations (:mod:`paylens.operators.boosting`) from labelled URLs: length,
depth, digit ratio, entropy, parameter counts, and how the URLs with the same suffix were labelled.
They become one expression over the features, so that pages are judged where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.boosting import Boost, Boosted, fit, margin, probability
from .store import picked
from .url_labels import LABELLED

# The rules of the registered query, a verdict with host and path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
FEATURES = ("f_length", "f_host", "f_labels", "f_depth", "f_digits", "f_entropy", "f_params", "f_query", "f_suffix_share", "f_suffix_rows")
TREES = Boost(trees=6, depth=3, rate=0.5, rows=1.0, columns=1.0, l2=1.0, least_weight=0.5, bins=32)


@dataclass(frozen=True)
class Suffixes:
    """How many labelled URLs have a suffix, and how many of them are to be dropped; of the most frequent
    ``limit`` suffixes. A suffix without rows has the share of all rows, which counts as ``prior`` rows elsewhere."""

    rows: tuple[tuple[str, int, int], ...]
    share: float
    prior: float = 2.0


@dataclass(frozen=True)
class UrlModel:
    trees: Boosted
    suffixes: Suffixes


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(url: Column) -> dict[str, Column]:
    """``host``, ``path`` and ``query``; all are empty without a ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    return {"host": _lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
            "query": F.regexp_extract(rest, "^[^?#]*\\?([^#]*)", 1)}


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits a character, from the counts of the text's distinct characters."""
    size = F.length(text).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
    bits = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(F.length(c) > 0, -share(c) * F.log2(share(c))).otherwise(F.lit(0.0)))
    return F.when(size > 0, F.aggregate(bits, F.lit(0.0), lambda s, x: s + x)).otherwise(F.lit(0.0))


def suffix(host: Column) -> Column:
    """What follows the host's last dot."""
    return F.substring_index(host, ".", -1)


def featured(rows: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` with ``host``, ``path``, and the features that need no labels."""
    rows = rows.withColumns(parsed(F.col(url))).withColumn("_text", F.coalesce(url, F.lit("")))
    text, size = F.col("_text"), F.greatest(F.length("_text"), F.lit(1))
    return rows.withColumns({
        "f_length": F.length(text), "f_host": F.length("host"), "f_labels": _count(F.col("host"), "."), "f_depth": _count(F.col("path"), "/"),
        "f_digits": F.length(F.regexp_replace(text, "[^0-9]", "")) / size, "f_entropy": entropy(text),
        "f_params": F.size(F.filter(F.split("query", "[&;]"), lambda x: F.length(x) > 0)), "f_query": F.length("query")}).drop("_text")


def _suffix_features(known: Suffixes, host: Column, own: Column | None = None) -> dict[str, Column]:
    """``own``: a row's own label, which is left out of its suffix's counts while learning."""
    at = suffix(host)
    table = F.create_map(*(F.lit(x) for name, n, bad in known.rows for x in (name, float(n)))) if known.rows else None
    bads = F.create_map(*(F.lit(x) for name, n, bad in known.rows for x in (name, float(bad)))) if known.rows else None
    n = F.coalesce(F.try_element_at(table, at), F.lit(0.0)) if known.rows else F.lit(0.0)
    bad = F.coalesce(F.try_element_at(bads, at), F.lit(0.0)) if known.rows else F.lit(0.0)
    if own is not None:
        n, bad = F.greatest(n - 1, F.lit(0.0)), F.greatest(bad - own, F.lit(0.0))
    return {"f_suffix_share": (bad + known.prior * known.share) / (n + known.prior), "f_suffix_rows": F.log1p(n)}


def suffix_counts(labelled: DataFrame, limit: int = 1000) -> Suffixes:
    rows = labelled.groupBy(suffix(F.col("host")).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("dropped").alias("bad"))
    top = rows.orderBy(F.desc("n"), "s").limit(limit).collect()
    n, bad = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("dropped"), F.lit(0))).first()
    return Suffixes(tuple((r.s, int(r.n), int(r.bad)) for r in top), bad / n if n else 0.0)


def train(labelled: DataFrame, params: Boost = TREES) -> UrlModel:
    """From ``url`` and ``dropped`` (0 or 1). Without labelled rows nothing is dropped."""
    rows = featured(labelled.filter("url is not null and dropped is not null").select("url", F.col("dropped").cast("int").alias("dropped")))
    known = suffix_counts(rows)
    rows = rows.withColumns(_suffix_features(known, F.col("host"), F.col("dropped")))
    return UrlModel(fit(rows, "dropped", FEATURES, (), ["url"], params), known)


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, dropped int")


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one. Rules of one length go by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last one is asked first
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``: one row for each row of ``pages``.

    ``rules`` are verdicts with a host and a path: a rule fits its host and all subdomains if the path starts
    with the rule's; the longest wins. Other URLs are blocked at a ``score`` above a half; the score is the trees' probability, rounded to
    6 places. A null URL, and one without ``://``, has an empty host and path, fits no rule and is judged by its text, a null as an empty one.
    Repeated rows get equal results; other columns play no part; an empty table gives an empty result.
    """
    if len(rules) > 1000:
        raise ValueError("at most 1000 rules become one expression")
    rows = featured(picked(pages, page_id=id_col, url=url_col))
    rows = rows.withColumns(_suffix_features(model.suffixes, F.col("host")))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    score = probability(margin(model.trees)) if model.trees.trees else F.lit(0.0)
    rows = rows.withColumn("_score", score)
    own = F.when(F.col("_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.round("_score", 6).alias("score"))


def allowed(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """The rows of ``pages``, all columns, whose URL :func:`judged` allows."""
    verdict = judged(pages.select(F.struct(*(f"`{c}`" for c in pages.columns)).alias("row"), F.col(f"`{url_col}`").alias("url")), model, rules, "row")
    return verdict.filter("verdict = 'allow'").select("page_id.*")
