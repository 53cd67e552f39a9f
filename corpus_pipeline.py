"""The corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.llm.language_id import in_a_language
from paylens.llm.near_dup import near_duplicates
from paylens.llm.queries import token_files
from paylens.llm.raking import sampled
from paylens.llm.store import by_ids, stored, table
from paylens.llm.tiling import without_leaks

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, and texts without a letter. A missing
    language becomes the one that the network predicts, which the later stages use."""
    return in_a_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; rows
    that repeat it, and rows without an id, stay too."""
    gone = near_duplicates(docs).filter("not kept").selectExpr("doc_id as id")
    return by_ids(docs, gone, "doc_id", "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in any order, go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that tokens match the target shares of sources, languages and topics.
    A missing language, and one without a target, has its own share of the tokens."""
    return sampled(docs).filter("__mix_kept").select(*(f"`{c}`" for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written to files and read back: start, length and checksum of each."""
    return token_files(spark, docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

#: No SQL can express these stages; tests hold each of them against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
