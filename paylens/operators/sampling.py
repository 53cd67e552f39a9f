"""Repeatable samples of an exact size, taken without gathering the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 16  # the hash range is counted in 2**BITS slots


def _hashed(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    hashed = df.withColumn("_hash", F.xxhash64(*keys, F.lit(seed)))
    return hashed.withColumn("_slot", F.shiftrightunsigned("_hash", 64 - BITS))


def _place(keys: Sequence[str], *group: str) -> Column:
    """The place of a row inside a slot."""
    rest = [F.col(f"`{x}`").asc_nulls_last() for x in keys]
    return F.row_number().over(Window.partitionBy(*group).orderBy("_hash", *rest))


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer): those with the smallest seeded hash
    of ``keys``, which should identify a row. The same input gives the same sample.

    Rows are counted per slot of the hash range (at most 2**BITS counts). Slots below the
    one where the count reaches ``n`` are kept whole by a plain filter; only that one slot,
    1/2**BITS of the table, is ordered to fill the sample up. So no task ever holds the
    sample, unlike with a sort and limit.
    """
    hashed = _hashed(df, keys, seed)
    counts = hashed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.orderBy("_slot"))  # at most 2**BITS rows
    last = (
        counts.withColumn("_upto", running)
        .filter(F.col("_upto") >= n)
        .agg(F.min(F.struct("_slot", "_upto", "_rows")).alias("_last"))
    )
    slot = F.coalesce(last.select("_last._slot").scalar(), F.lit(1 << BITS))
    room = last.select(F.lit(n) - F.col("_last._upto") + F.col("_last._rows")).scalar()

    whole = hashed.filter(F.col("_slot") < slot)
    part = hashed.filter(F.col("_slot") == slot).withColumn("_place", _place(keys, "_slot"))
    part = part.filter(F.col("_place") <= room).drop("_place")
    return whole.unionByName(part).drop("_hash", "_slot")


def stratified_cap(
    df: DataFrame, column: str, strata: Mapping[str, int], keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """Thin a table to at most the given number of rows per stratum; strata that are not
    named are dropped. A table has no row order, so "the first n" and "a sample of n" are
    the same repeatable choice here."""

    # All strata are counted by slot in one pass, and cut as ``sample_n`` cuts a table.
    if not strata:
        return df.limit(0)
    cap = F.create_map(*(F.lit(x) for pair in strata.items() for x in pair))
    hashed = _hashed(df.filter(F.col(column).isin(*strata)), keys, seed)
    counts = hashed.groupBy(F.col(column).alias("_stratum"), "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.partitionBy("_stratum").orderBy("_slot"))  # at most 2**BITS rows a stratum
    last = (
        counts.withColumn("_upto", running)
        .filter(F.col("_upto") >= cap[F.col("_stratum")])
        .groupBy("_stratum").agg(F.min(F.struct("_slot", "_upto", "_rows")).alias("_last"))
        .select("_stratum", F.col("_last._slot").alias("_end"), (cap[F.col("_stratum")] - F.col("_last._upto") + F.col("_last._rows")).alias("_room"))
    )
    placed = hashed.join(F.broadcast(last), F.col(column) == F.col("_stratum"), "left")  # a row for each named stratum at most
    whole = placed.filter("_end is null or _slot < _end")
    part = placed.filter("_slot = _end").withColumn("_place", _place(keys, "_stratum", "_slot"))
    part = part.filter("_place <= _room").drop("_place")
    return whole.unionByName(part).select(*(F.col(f"`{x}`") for x in df.columns))
