"""Raw tables: full load, append or replace a year, status, counts.

A raw table is versioned (:mod:`versions`): a load writes a new folder, laid out by ``year`` if its rows have one, and a
commit to the manifest makes its rows count and ends those they replace. So readers see the old rows or the new ones, and a repeated or
retried load replaces what it wrote before instead of adding to it.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.reports import row_counts
from . import versions
from .files import PREFIX, entry_name, list_files, load_files, route, route_files, select_files

log = logging.getLogger(__name__)
UNREADABLE = (PySparkException, Py4JJavaError, ValueError)  # a failed task surfaces as the second


def now() -> datetime:
    return datetime.now(timezone.utc)


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table can be read there."""
    return versions.exists(spark, path)


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table with ``year`` as text, as it was loaded."""
    return versions.read(spark, table_path(root, table))


def write_raw(df: DataFrame, path: str, replace_table: bool, sources: Sequence[str] = ()) -> int:
    """Make the rows of ``df`` those of the table, or of the files that ``df`` has rows of. Returns them.
    ``sources``: the paths they come from, whose lengths and times are kept."""
    known = signatures(df.sparkSession, sources) if sources else {}
    return versions.publish(df, path, versions.TABLE if replace_table else versions.FILE, signatures=known)


def source_name(path: str) -> str:
    """What :func:`files.add_lineage` calls the file or part at a path."""
    return re.search(r"[^/]+(?:\.csv/[^/]+)?$", path)[0].removeprefix(PREFIX)


def signatures(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Length and time of every file and part, by its name. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    rows = found.select("path", "length", "modificationTime").collect()  # a row for each file
    return {source_name(r.path): f"{r.length} {r.modificationTime.isoformat()}" for r in rows}


class LoadError(RuntimeError):
    """Files that could not be read; ``files`` has their paths and reasons, ``loaded`` the row
    counts of the tables that were loaded without them."""

    def __init__(self, files: Mapping[str, str], loaded: DataFrame | None):
        super().__init__("; ".join(f"{path}: {reason[:300]}" for path, reason in files.items()))
        self.files, self.loaded = dict(files), loaded


def full_load(spark: SparkSession, folder: str, root: str, only: Sequence[str] | None = None) -> DataFrame:
    """Load a folder: the files of a table replace it. Returns the row counts of the tables that
    were loaded. A file that cannot be read does not keep the others from being loaded, but the
    load then ends with a :class:`LoadError` that names it."""
    files = list_files(spark, folder)
    chosen = select_files(files, only)
    for row in chosen.filter(~F.col("found")).collect():
        log.warning("not in %s: %s", folder, row.file)
    paths = sorted(row.path for row in files.join(chosen.filter("found"), "file").select("path").collect())
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    by_table: dict[str, list[str]] = {}
    for path in paths:
        by_table.setdefault(route(path)[0], []).append(path)

    loaded: list[str] = []
    failed: dict[str, str] = {}
    for table, members in by_table.items():
        target = table_path(root, table)
        try:
            write_raw(load_files(spark, members, now()), target, True, members)
            loaded.append(table)
        except UNREADABLE:  # find the file at fault and load the others
            first = True
            for path in members:
                try:
                    write_raw(load_files(spark, [path], now()), target, first, [path])
                    first = False
                except UNREADABLE as error:
                    failed[path] = str(error)
            if not first:
                loaded.append(table)
    counts = row_counts({t: read_raw(spark, root, t) for t in loaded}) if loaded else None
    if failed:
        raise LoadError(failed, counts)
    return counts


def file_state(spark: SparkSession, root: str, table: str) -> dict[str, dict[str, str | None]]:
    """Of every file that a table has, its parts and what they were like when they were loaded; from the manifest."""
    path, out = table_path(root, table), {}
    if exists(spark, path):
        rows = versions.live(spark, path).groupBy("file").agg(F.min("signature").alias("signature"), F.sum("rows").alias("rows")).collect()
        for r in rows:  # a row for each part
            out.setdefault(r.file.split("/")[0], {})[r.file] = r.signature
    return out


def replace_year(df: DataFrame, root: str, table: str, year: int | str, sources: Sequence[str] = ()) -> int:
    """Make ``df`` the only rows of that year; the rows of other years stay as they are. Raises before anything
    counts if ``df`` has rows of another year, or without one. Rows are counted as they are written, so
    the source is read once, and it cannot change between the count and the write. Returns the rows."""
    known = signatures(df.sparkSession, sources) if sources else {}
    return versions.publish(df, table_path(root, table), versions.YEAR, str(year), known)


def append_year(spark: SparkSession, path: str, root: str, replace: bool = False) -> int:
    """Add a yearly file to its table. A file that was loaded whole and has not changed since is left alone
    unless ``replace``, without reading it; otherwise its rows become those of the year. Returns the rows written."""
    table, year = route(path)
    if year is None:
        raise ValueError(f"{path}: the file name must have a 4-digit year")
    before = file_state(spark, root, table).get(entry_name(path))
    if before and not replace and before == signatures(spark, [path]):
        log.info("%s %s is complete", table, year)
        return 0
    return replace_year(load_files(spark, [path], now()), root, table, year, [path])


def changed_files(spark: SparkSession, paths: Sequence[str], root: str) -> list[str]:
    """Of the given files those that their table has, but as they were before they changed."""
    like = signatures(spark, paths) if paths else {}
    kept: dict[str, str | None] = {}
    for table in sorted({route(path)[0] for path in paths}):
        for parts in file_state(spark, root, table).values():
            kept |= parts
    changed = {part.split("/")[0] for part, now_like in like.items() if kept.get(part) not in (None, now_like)}
    return [path for path in paths if entry_name(path) in changed]


# Status ---------------------------------------------------------------------------------------
def file_counts(spark: SparkSession, paths: Sequence[str], at: datetime | None = None) -> DataFrame:
    """Parsed data rows per file (a line count would count quoted line breaks as rows). All columns are parsed, so that
    a file with a row that does not fit its header raises here as it would in a load."""
    frames = load_files(spark, paths, at or now())
    name = F.element_at(F.split(versions.SOURCE, "/"), 1)
    parsed = F.max(F.xxhash64(*(f"`{c}`" for c in frames.columns)))
    counted = frames.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("file_rows"), parsed.alias("_parsed"))
    return route_files(counted.filter("_parsed is not null or file_rows >= 0").drop("_parsed"))


def loaded_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and year of the loaded tables (year null where a table has none)."""
    parts = []
    for name, df in tables.items():
        year = F.col("year").cast("string") if "year" in df.columns else F.lit(None).cast("string")
        parts.append(
            df.groupBy(year.alias("year"))
            .agg(F.count(F.lit(1)).alias("table_rows"))
            .select(F.lit(name).alias("table"), "year", "table_rows")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_status(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """File rows against loaded rows. A file with a year is compared with that year of its
    table, any other file with the whole table. Complete means all rows."""
    by_year = loaded.filter(F.col("year").isNotNull()).select(
        F.col("table").alias("t"), F.col("year").alias("y"), F.col("table_rows").alias("year_rows")
    )
    whole = loaded.groupBy(F.col("table").alias("t")).agg(F.sum("table_rows").alias("all_rows"))
    joined = (
        files.join(by_year, (F.col("table") == F.col("t")) & (F.col("year") == F.col("y")), "left")
        .drop("t", "y")
        .join(whole, F.col("table") == F.col("t"), "left")
    )
    rows = F.coalesce(F.when(F.col("year").isNotNull(), F.col("year_rows")).otherwise(F.col("all_rows")), F.lit(0))
    counted = joined.select("file", "table", "year", "file_rows", rows.cast("bigint").alias("table_rows"))
    complete = F.col("table_rows") >= F.col("file_rows")
    share = F.floor(F.col("table_rows") * 100 / F.nullif(F.col("file_rows"), F.lit(0))).cast("int")  # 100 only when complete
    return counted.withColumn(
        "status",
        F.when(complete, F.lit("COMPLETE"))
        .when(F.col("table_rows") > 0, F.concat(F.coalesce(share, F.lit(0)).cast("string"), F.lit("% DONE")))
        .otherwise(F.lit("NOT STARTED")),
    )


def approx_rows(spark: SparkSession, path: str) -> DataFrame:
    """Row count from the manifest of a raw table, or from the Parquet footers; 0 for a table that is not there."""
    if exists(spark, path):
        return versions.live(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    try:
        return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))


def catalog_rows(spark: SparkSession, table: str) -> int | None:
    """Row count from the catalog's statistics (after ``ANALYZE TABLE``), without a scan."""
    details = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").head()
    found = details and [x for x in details.data_type.split(",") if x.strip().endswith("rows")]
    return int(found[0].split()[0]) if found else None
