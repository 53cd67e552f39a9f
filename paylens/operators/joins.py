"""Fact-to-lookup joins that hold when one key owns a large share of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 256


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for a frame; very large when it has no idea."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def mean_share(spark: SparkSession) -> float:
    """The share of the rows that a shuffle partition gets on average."""
    return 1 / max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float | None = None, weight: str | None = None) -> DataFrame:
    """Keys that own more than ``share`` of the rows, by default more than an average partition:
    never more than ``1/share`` of them. Counting is combined before the shuffle, so a hot key costs one row per task.
    ``weight``: a column with the rows that a row of ``df`` stands for."""
    share = mean_share(df.sparkSession) if share is None else share
    sizes = df.groupBy(*keys).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_rows"))
    total = sizes.agg(F.sum("_rows")).scalar()  # from the same counts, not a second scan
    return sizes.filter(F.col("_rows") > total * F.lit(share)).drop("_rows")


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "left",
    sizes: DataFrame | None = None,
    share: float | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which only the hot keys are salted.

    The salt comes from a hash of ``spread_on`` (columns that tell the rows of one key
    apart), so a recomputed task gives the same rows. Lookup rows of hot keys are copied
    once per salt; all other lookup rows stay single. ``sizes`` may name a cheaper frame
    to count the keys on (for example the raw table below a de-duplication).
    """
    hot = hot_keys(facts if sizes is None else sizes, keys, share).withColumn("_hot", F.lit(True))
    hot = F.broadcast(hot)  # at most 1/share rows by construction
    salt = F.pmod(F.xxhash64(*spread_on), F.lit(salts)).cast("int")
    no_key = reduce(or_, (F.col(x).isNull() for x in keys))  # matches nothing, but must not pile up
    spread = (
        facts.join(hot, list(keys), "left")
        .withColumn("_salt", F.when(F.col("_hot") | no_key, salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))
    copies = (
        lookup.join(hot, list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_hot")
    )
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str = "left",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Join facts to a lookup with unique keys. While the lookup's estimated size is below
    the session's broadcast threshold Catalyst broadcasts it and the facts do not move;
    beyond that the join shuffles with hot keys salted."""
    if estimated_bytes(lookup) <= broadcast_limit(lookup):
        return facts.join(lookup, list(keys), how)
    return salted_join(facts, lookup, keys, spread_on, how, sizes)


def with_distinct(groups: DataFrame, rows: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """``groups``, aggregated from ``rows`` by ``keys``, with the number of different values that a group has in ``column``.

    In one aggregate with them the sums would be shuffled once for each value in a group, which for ids is nearly as often as
    there are rows. Here only the value and its group are. ``rows`` is read twice, so it should be a stored table."""
    counts = rows.groupBy(*(F.col(x).alias(f"_in_{x}") for x in keys)).agg(F.count_distinct(column).alias(name))
    same = reduce(and_, (F.col(x).eqNullSafe(F.col(f"_in_{x}")) for x in keys))
    return groups.join(counts, same).select(*keys, name, *(x for x in groups.columns if x not in keys))
