"""Running totals in the order of all rows, without a task that walks through all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir


def sliced(rows: DataFrame, order: Sequence[Column | str], slices: int | None = None, name: str = "_slice") -> DataFrame:
    """The rows with the number of their slice: ranges in the given order, about equal in rows, by default
    as many as the session's shuffle partitions. Rows that tie in ``order`` share a slice.

    Spark finds the ranges by a sample, so they may differ from run to run. They are therefore
    written once, to the shared work folder, and everything that is computed by slice reads that table.
    """
    spark = rows.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, "ranges")
    rows.repartitionByRange(slices, *order).withColumn(name, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def running_sums(
    rows: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    slices: int | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the sum of a column over this row and all rows before it in ``order``, for each name and
    column of ``sums``, within each group of ``by``. ``totals`` adds sums over the whole group.

    A sum is null while only nulls came, as in SQL. ``order`` should tell the rows of a group apart: those
    that tie come in any order. A large group is spread over many slices (``sliced``); running
    sums inside each slice are raised by what the slices before it sum up to, of which there is one row
    for each slice and group. Repeated rows stay; an empty table gives an empty result.
    """
    by, totals = list(by), totals or {}
    ranged = sliced(rows, [*by, *order], slices)
    wanted = sorted({*sums.values(), *totals.values()})
    part = {x: f"_part_{i}" for i, x in enumerate(wanted)}
    parts = ranged.groupBy(*by, "_slice").agg(*(F.sum(x).alias(part[x]) for x in wanted))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *(F.col(x).alias(f"_by_{i}") for i, x in enumerate(by)), F.col("_slice").alias("_of"),
        *(F.sum(part[x]).over(earlier).alias(f"_before_{name}") for name, x in sums.items()),
        *(F.sum(part[x]).over(group).alias(name) for name, x in totals.items()),
    )
    same = F.col("_slice") == F.col("_of")
    for i, x in enumerate(by):
        same = same & F.col(x).eqNullSafe(F.col(f"_by_{i}"))
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.select("*", *(F.sum(x).over(inside).alias(f"_inside_{name}") for name, x in sums.items())).join(offsets, same)
    for name in sums:
        before, own = F.col(f"_before_{name}"), F.col(f"_inside_{name}")
        out = out.withColumn(name, F.coalesce(before + F.coalesce(own, F.lit(0)), own))
    return out.select(*(F.col(f"`{x}`") for x in (*rows.columns, *sums, *totals)))
