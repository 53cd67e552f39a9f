"""CSV files with line breaks inside quotes, read in splits by many tasks.

A record ends at a line break outside quotes, and whether a break is outside depends on all quotes
before it. Splits are read by themselves: each line has its number of quotes, each split their sum. A running
sum over the splits of a file, a few numbers, tells whether a split begins inside quotes and which record it goes on with.
Lines that begin outside quotes begin a record; the lines of a record are put together, also across splits. Only records of more than
one line are grouped. Doubled quotes, as escapes, do not change whether a number is odd.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PATH = "_quoted_path"  # the file of a record


def numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path``, ``split`` (where it begins), ``line`` (its place in the split), ``value``, ``odd`` (of quotes: 0 or 1)."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value", (quotes % 2).alias("odd"))


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path``, ``split`` and ``line`` of every record's first line, and ``value``, its text. Blank records are left out."""
    lines = numbered_lines(spark, paths)
    inside = Window.partitionBy("path", "split").orderBy("line")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("before", before % 2)
    # of each split: its quotes, and its last line that begins a record, for either way the split may begin
    starts = lambda open_: F.max(F.when(F.col("before") == open_, F.col("line")))
    splits = lines.groupBy("path", "split").agg((F.sum("odd") % 2).alias("odd"), starts(0).alias("closed_last"), starts(1).alias("open_last"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("opens", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    last = F.when(F.col("opens") == 0, F.col("closed_last")).otherwise(F.col("open_last"))
    splits = splits.withColumn("last", F.when(last.isNotNull(), F.struct("split", last.alias("line"))))
    splits = splits.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
    lines = lines.join(splits.select("path", "split", "opens", "carried"), ["path", "split"])
    begins = F.col("before") == F.col("opens")
    own = F.last(F.when(begins, F.struct("split", "line")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.withColumn("record", F.coalesce(own, "carried")).withColumn("goes_on", (F.col("odd") == 1) | ~begins)
    # a line that neither goes on with a record nor leaves one open is a record by itself
    single = lines.filter(~F.col("goes_on")).select("path", "record.split", "record.line", "value")
    parts = lines.filter("goes_on").groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("parts"))
    joined = parts.select("path", "record.split", "record.line", F.array_join(F.transform("parts", lambda x: x.value), "\n").alias("value"))
    whole = single.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))
    return whole.filter(F.trim("value") != "")


def parsed(spark: SparkSession, paths: Sequence[str], header: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    """The records of files with the same header as text columns, and ``PATH``, the file of each. The first record of
    every file is its header."""
    found = records(spark, paths)
    first = found.groupBy("path").agg(F.min(F.struct("split", "line")).alias("first"))
    body = found.join(F.broadcast(first), "path").filter(F.struct("split", "line") > F.col("first"))  # a row for each file
    schema = ", ".join(f"`c{i}` string" for i in range(len(header)))
    row = F.from_csv("value", schema, {k: v for k, v in options.items() if k not in ("header", "inferSchema")})
    return body.select(F.col("path").alias(PATH), row.alias("_row")).select(
        PATH, *(F.col(f"_row.c{i}").alias(name) for i, name in enumerate(header)))
