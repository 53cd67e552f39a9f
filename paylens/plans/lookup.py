"""Registry search and the detail lines of one provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as k
from .reports import top


def lookup_by_id(dim: DataFrame, prefix: str, n: int = 50) -> DataFrame:
    """Ids that start with ``prefix``; the prefix test is pushed into the scan."""
    return dim.filter(F.col("npi").startswith(prefix)).orderBy("npi").limit(n).select(*k.CARD)


def lookup_by_name(dim: DataFrame, text: str, n: int = 50) -> DataFrame:
    """Names that contain ``text`` in any letter case."""
    hits = dim.filter(F.lower("display_name").contains(text.lower()))
    return hits.orderBy("display_name", "npi").limit(n).select(*k.CARD)


GRAM = 3  # letters of a posting


def write_name_index(dim: DataFrame, path: str) -> None:
    """The names by their letter triples, in any letter case: a posting for each triple and name, and the
    number of postings of each triple.

    Postings carry the name and are laid out by triple, name and id, in ranges of even size, so a
    triple that very many names have takes several files instead of one task. They hold a name about
    as many times as it has letters; neighbouring ones are alike, which Parquet packs well.
    """
    name = F.lower("display_name")
    starts = F.sequence(F.lit(1), F.length(name) - F.lit(GRAM - 1))
    triples = F.array_distinct(F.transform(starts, lambda at: name.substr(at, F.lit(GRAM))))
    postings = dim.filter(F.length(name) >= GRAM).select(F.explode(triples).alias("gram"), "display_name", "npi")
    layout = ["gram", "display_name", "npi"]
    postings.repartitionByRange(*layout).sortWithinPartitions(*layout).write.mode("overwrite").parquet(f"{path}/postings")
    written = dim.sparkSession.read.parquet(f"{path}/postings")
    written.groupBy("gram").agg(F.count(F.lit(1)).alias("names")).write.mode("overwrite").parquet(f"{path}/grams")


def indexed_by_name(dim: DataFrame, index: str, text: str, n: int = 50) -> DataFrame:
    """The rows of ``lookup_by_name``, found by the postings of the text's rarest triple.

    The names in them are verified, and only the ``n`` ids that are left go to the registry, as a filter
    that its scan takes. A text shorter than a triple has no postings and is searched by a scan.
    """
    spark, text = dim.sparkSession, text.lower()
    grams = {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}
    if not grams:
        return lookup_by_name(dim, text, n)
    counts = spark.read.parquet(f"{index}/grams").filter(F.col("gram").isin(*grams))
    known = {r.gram: r.names for r in counts.collect()}  # a row for each triple of the text at most
    if len(known) < len(grams):  # no name has all of them
        return dim.select(*k.CARD).limit(0)
    rarest = min(grams, key=lambda gram: (known[gram], gram))
    postings = spark.read.parquet(f"{index}/postings").filter(F.col("gram") == rarest)
    hits = postings.filter(F.lower("display_name").contains(text)).orderBy("display_name", "npi").limit(n)
    ids = [r.npi for r in hits.select("npi").collect()]  # n at most
    return dim.filter(F.col("npi").isin(*ids)).orderBy("display_name", "npi").select(*k.CARD)


def lookup(dim: DataFrame, text: str, n: int = 50, index: str | None = None) -> DataFrame:
    """Digits search ids, anything else searches names, by an index if there is one; blank input finds nothing."""
    text = (text or "").strip()
    if not text:
        return dim.select(*k.CARD).limit(0)
    if text.isdigit():
        return lookup_by_id(dim, text, n)
    return indexed_by_name(dim, index, text, n) if index else lookup_by_name(dim, text, n)


def provider_detail(utilization: DataFrame, npi: str, n: int = 25) -> DataFrame:
    """A provider's lines with the highest withhold rates; lines without a rate come last."""
    columns = (
        "cms_specialty", "hcpcs_code", "hcpcs_description", "year", "service_count",
        "avg_medicare_payment", "implied_withhold_rate",
    )
    lines = utilization.filter(F.col("npi") == npi)
    return top(lines, "implied_withhold_rate", n, "hcpcs_code", "year", "place_of_service").select(*columns)
