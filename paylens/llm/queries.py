"""The registered queries of this subpackage, each over its whole table, and their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import bag_search, raking, url_filter, warc
from .alignment import token_links
from .html_blocks import extract
from .language_id import identify
from .licenses import find_licenses
from .lz_prints import fingerprints
from .near_dup import Rule, near_duplicates
from .pii import find_personal
from .store import table
from .tiling import contaminated
from .token_files import read_tokens, write_tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents"))


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents' ids, written and read back: where each begins, how many, their checksum."""
    path = work_dir(spark, "tokens")
    write_tokens(docs, path, VOCABULARY)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))


def op4_lz_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as response records, and the records derived from these."""
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op7_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raking.sampled(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.col("__mix_source").alias("source"), F.col("__mix_lang").alias("lang"), F.col("__mix_topic").alias("topic"),
        F.col("__mix_tokens").alias("n_tokens"), F.round("__mix_probability", 6).alias("probability"), F.col("__mix_kept").alias("kept"))


def op8_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=2))


def op11_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judged(table(spark, sf_dir, "pages"), model)


def op12_lockstep(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return token_links(table(spark, sf_dir, "documents"), *paths, ranks=ranks)


def op13_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_crf": op1_pii_crf,
    "op2_string_tiling": op2_string_tiling,
    "op3_rans": op3_rans,
    "op4_lz_phrases": op4_lz_phrases,
    "op5_html_blocks": op5_html_blocks,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_raking": op7_raking,
    "op8_license_compression": op8_license_compression,
    "op9_byte_cnn": op9_byte_cnn,
    "op10_minhash": op10_minhash,
    "op11_url_trees": op11_url_trees,
    "op12_lockstep": op12_lockstep,
    "op13_bag_search": op13_bag_search,
}

ORACLES: dict[str, str] = {"op7_raking": raking.oracle(), "op13_bag_search": bag_search.oracle()}
