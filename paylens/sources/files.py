"""Yearly CSV files: listing, routing, reading as text, lineage."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as k
from ..functions.columns import normalize_headers, null_tokens
from . import quoted

SOURCE = "_source_file"
# A row with too many or too few fields stops the read; it is never cut or filled up.
CSV_OPTIONS = {"header": "true", "escape": '"', "inferSchema": "false", "mode": "FAILFAST"}


# Listing and routing ----------------------------------------------------------------------
# A "file" of a folder is a plain ``name.csv``, or a directory ``name.csv`` (also
# ``file=name.csv``) of part files, as Spark writes a large yearly file.
PART = r"(\.csv)/[^/]+$"
PREFIX = "file="


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder, empty ones too. The listing is asked for, no content is read."""
    paths = spark.read.text(f"{folder.rstrip('/')}/*.csv").inputFiles()  # names of files, not data
    entries = sorted({(re.sub(PART, r"\1", path), entry_name(path)) for path in map(unquote, paths)})
    return spark.createDataFrame(entries, "path string, file string")


def select_files(files: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The files to load, by name in any letter case (all of them without ``only``), and a
    ``found = false`` row for each name that is not there. Sorted by name."""
    if not only:
        return files.select("file", F.lit(True).alias("found")).orderBy("file")
    wanted = files.sparkSession.createDataFrame([(x.lower(),) for x in sorted(set(only))], "name string")
    named = files.withColumn("name", F.lower("file"))
    present = named.join(F.broadcast(wanted), "name", "left_semi").select("file", F.lit(True).alias("found"))
    missing = wanted.join(named, "name", "left_anti").select(F.col("name").alias("file"), F.lit(False).alias("found"))
    return present.unionByName(missing).orderBy("file")


def stem(file: Column) -> Column:
    return F.regexp_replace(file, r"\.[^.]*$", "")


def table_of(file_stem: Column, routes: Mapping[str, str] = k.FILE_ROUTES) -> Column:
    """Canonical table of a file stem: the first pattern that matches all of it, else the stem."""
    table = file_stem
    for pattern, name in reversed(routes.items()):
        table = F.when(file_stem.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(table)
    return table


def year_of(file_stem: Column) -> Column:
    """First four digits in a row, as text; null without any."""
    return F.nullif(F.regexp_extract(file_stem, r"(\d{4})", 1), F.lit(""))


def route_files(files: DataFrame, routes: Mapping[str, str] = k.FILE_ROUTES) -> DataFrame:
    name = stem(F.col("file"))
    return files.withColumn("table", table_of(name, routes)).withColumn("year", year_of(name))


def entry_name(path: str) -> str:
    """Name of the file that a path, or the path of one of its parts, belongs to."""
    return re.sub(PART, r"\1", path.rstrip("/")).rsplit("/", 1)[-1].removeprefix(PREFIX)


def route(path: str, routes: Mapping[str, str] = k.FILE_ROUTES) -> tuple[str, str | None]:
    """Table and year of one path, for driver-side planning of a load."""
    name = re.sub(r"\.[^.]*$", "", entry_name(path))
    table = next((t for pattern, t in routes.items() if re.fullmatch(pattern, name)), name)
    year = re.search(r"\d{4}", name)
    return table, year.group(0) if year else None


# Reading ------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Part:
    """A file or part file: its header line, whether it has line breaks inside quotes, told
    by a line with an odd number of quotes, and its path as rows name it."""

    path: str
    header: str
    whole: bool
    uri: str


def survey(spark: SparkSession, paths: str | Sequence[str]) -> list[Part]:
    """One parallel pass over the lines of all files; files without a line are left out."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).filter(F.trim("value") != "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    placed = lines.select(
        F.col("_metadata.file_path").alias("path"), "value", (quotes % 2 == 1).alias("odd"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"))
    found = placed.groupBy("path").agg(F.min_by("value", "place").alias("header"), F.bool_or("odd").alias("whole"))
    return [Part(unquote(r.path), r.header, r.whole, r.path) for r in found.orderBy("path").collect()]  # a row for each file


def scans(spark: SparkSession, parts: Sequence[Part]) -> list[DataFrame]:
    """Text frames of the parts: those with the same header line are one scan, so that columns are
    read by name even where parts order them differently. All of them are read in splits; those with line breaks inside
    quotes by :mod:`quoted`, unless the header itself has one, or names that are missing or twice there."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for part in parts:
        groups.setdefault((part.header, part.whole), []).append(part.path)
    frames = []
    for (header, whole), members in groups.items():
        names = next(csv.reader([header.rstrip("\r")]), [])
        if whole and header.count('"') % 2 == 0 and all(names) and len({x.lower() for x in names}) == len(names):
            frames.append(quoted.parsed(spark, members, names, CSV_OPTIONS))
        else:
            frames.append(spark.read.options(**CSV_OPTIONS).option("multiLine", whole).csv(members))
    return frames


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with every column as text. Raises where no file has a header line."""
    frames = scans(spark, survey(spark, paths))
    if not frames:
        raise ValueError(f"{paths}: no header line")
    if len(frames) == 1 and quoted.PATH not in frames[0].columns:
        return frames[0]  # with the file's metadata columns
    return union_years([frame.drop(quoted.PATH) for frame in frames])


def _file_name(path: Column | str) -> Column:
    """What a row's file is called: its name, with the part for a file that is a directory of parts."""
    return F.regexp_replace(F.regexp_extract(path, r"[^/]+(?:\.csv/[^/]+)?$", 0), f"^{PREFIX}", "")


def _file_year(name: Column | str) -> Column:
    return year_of(stem(F.element_at(F.split(name, "/"), 1)))


def names_of(spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
    """A row for each part: its path, and the name and year that its rows get."""
    paths = spark.createDataFrame([(part.uri,) for part in parts], "_part string")
    named = paths.withColumn("_part_name", _file_name("_part")).withColumn("_part_year", _file_year("_part_name"))
    # values: Spark would infer filters on the expressions for the scans as well
    return spark.createDataFrame(named.collect(), named.schema)  # a row for each part


def add_lineage(df: DataFrame, loaded_at: datetime | str, names: DataFrame | None = None) -> DataFrame:
    """File name, load time, and the year from the file name if the file has no such column.
    The file name includes the part for a file that is a directory of parts.

    ``names``: optional, of :func:`names_of`; name and year are then worked out once for a file, not for every row
    and, as filters repeat the expressions they are on, many times over."""
    path, had = quoted.PATH if quoted.PATH in df.columns else "_metadata.file_path", df.columns
    name, year = _file_name(path), _file_year(SOURCE)
    if names is not None:
        df = df.select("*", F.col(path).alias("_path")).join(F.broadcast(names), F.col("_path") == F.col("_part"), "left")
        name, year = F.col("_part_name"), F.col("_part_year")
    out = df.withColumn(SOURCE, name)
    if "year" not in [x.strip().lower() for x in had]:
        out = out.withColumn("year", year)
    return out.drop(quoted.PATH, "_path", "_part", "_part_name", "_part_year").withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp"))


def load_files(spark: SparkSession, paths: Sequence[str], loaded_at: datetime | str) -> DataFrame:
    """Files of one table as one text frame; a column that only some files have is null in the
    others. Raises for a file without a header line, and, when rows are read, for a row that
    does not fit its header."""
    parts = survey(spark, paths)
    found = {entry_name(part.path) for part in parts}
    if empty := [path for path in paths if entry_name(unquote(path)) not in found]:
        raise ValueError(f"no header line: {', '.join(empty)}")
    names = names_of(spark, parts)
    return union_years([null_tokens(normalize_headers(add_lineage(frame, loaded_at, names))) for frame in scans(spark, parts)])


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack yearly frames whose columns differ."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
