"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row of each key under ``order`` and then ``tiebreak`` (ascending,
    nulls last), so that the survivor does not depend on how the rows are spread.

    The rank filter becomes a group limit that runs before the shuffle as well: however
    many copies a key has, each input task sends one row of it.
    """
    ranking = [*order, *(F.col(f"`{c}`").asc_nulls_last() for c in tiebreak)]
    w = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def one_per_key(df: DataFrame, key: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Any one row per key, made repeatable by ordering on the other columns."""
    rest = [c for c in (tiebreak or df.columns) if c != key]
    return latest_per_key(df, [key], tiebreak=rest)
