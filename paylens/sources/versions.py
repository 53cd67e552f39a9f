"""Tables whose content changes all at once: version folders, and a manifest that says which rows count.

    <table>/data/v=<version>/year=<year>/...   rows of one load, never changed afterwards
    <table>/manifest/part-...parquet           one file for each commit

A load writes a new version folder and then appends one file to the manifest, which Spark renames into place at the end.
Readers go by the manifest alone: until that file is there they see the old rows, whatever was written; from then on the
new ones. A load that dies in between leaves a folder that no reader opens. A commit ends what it replaces: the whole table, the
years it names, or the files it has rows of. Rows are counted by the write itself and by source file in what was written; if
both differ nothing is published. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import SOURCE

TABLE, YEAR, FILE = "table", "year", "file"  # what a commit ends
MANIFEST = ("number long, version string, at timestamp, ends string, year string, file string, rows long, "
            "signature string, schema string")


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """All commits, a row for each source file and year; None for a table without one."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    found = manifest(spark, path)
    return found is not None and not found.isEmpty()


def units(commits: DataFrame) -> DataFrame:
    """The manifest's rows with ``alive``: whether the rows they count still belong to the table."""
    year, file = Window.partitionBy("year"), Window.partitionBy("file")
    last = lambda kind, over: F.coalesce(F.max(F.when(F.col("ends") == kind, F.col("number"))).over(over), F.lit(-1))
    # one number for the table, counted apart so that no task gets all rows
    whole = commits.agg(F.coalesce(F.max(F.when(F.col("ends") == TABLE, F.col("number"))), F.lit(-1)).alias("_whole"))
    rows = commits.join(F.broadcast(whole)).withColumns({"_year": last(YEAR, year), "_file": last(FILE, file)})
    n = F.col("number")
    alive = (n >= F.col("_whole")) & (n >= F.col("_year")) & (n >= F.col("_file")) & F.col("file").isNotNull()
    return rows.withColumn("alive", alive).drop("_whole", "_year", "_file")


def live(spark: SparkSession, path: str) -> DataFrame:
    """A row for each source file and year that the table has rows of."""
    return units(manifest(spark, path)).filter("alive").drop("alive")


def _merged(schemas: Sequence[str]) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for text in schemas:
        for field in T.StructType.fromJson(json.loads(text)):
            if fields.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"{field.name} has two types in one table")
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows that count. Columns come from the manifest, so no footer is opened to find them; folders without a
    row that counts are not read, and others are filtered only where some of their files were replaced."""
    found = units(manifest(spark, path))
    state = found.groupBy("version", "year").agg(
        F.count_if("alive").alias("alive"), F.count_if(~F.col("alive") & F.col("file").isNotNull()).alias("dead"),
        F.first("schema").alias("schema"), F.min("number").alias("number")).orderBy("number").collect()  # a row for each year of a commit
    used = [r for r in state if r.alive]
    schema = _merged([r.schema for r in used or state[-1:]])
    if not used:
        return spark.createDataFrame([], schema)
    timed = "year" in schema.names
    files = spark.read.schema(T.StructType([*schema, T.StructField("v", T.StringType())])).option("basePath", _data(path)).parquet(
        *(f"{_data(path)}/v={v}" for v in dict.fromkeys(r.version for r in used)))

    def within(rows: Sequence) -> Column:
        out = F.lit(False)
        for r in rows:
            out = out | ((F.col("v") == r.version) & (F.col("year").eqNullSafe(r.year) if timed else F.lit(True)))
        return out

    whole = [r for r in used if not r.dead]
    mixed = [r for r in used if r.dead]
    parts = [files.filter(within(whole))] if whole else []
    if mixed:
        left = found.filter("alive").select(F.col("version").alias("_v"), F.col("year").alias("_y"), F.col("file").alias("_f"))
        same = (F.col("v") == F.col("_v")) & (F.col(SOURCE) == F.col("_f")) & (F.col("year").eqNullSafe(F.col("_y")) if timed else F.lit(True))
        parts.append(files.filter(within(mixed)).join(left, same, "left_semi"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.drop("v")


def publish(df: DataFrame, path: str, ends: str, year: str | None = None, signatures: Mapping[str, str] | None = None,
            commit: Callable[[DataFrame, str], None] | None = None) -> int:
    """Write ``df`` as a new version and make it count; returns its rows. With ``year``, all rows have to be of
    that year, else nothing is published, and the year's old rows end even if there are no new ones.

    ``signatures``: of source files, kept with their counts. ``commit`` appends to the manifest (for tests).
    """
    spark, version, timed = df.sparkSession, uuid.uuid4().hex[:12], "year" in df.columns
    if timed:
        df = df.withColumn("year", F.col("year").cast("string"))
    own = F.coalesce(F.col("year") == str(year), F.lit(False)) if year is not None else F.lit(True)
    seen = Observation(f"version-{version}")
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~own).alias("others"))
    folder = f"{_data(path)}/v={version}"
    writer = rows.write.option("compression", "zstd")
    (writer.partitionBy("year") if timed else writer).parquet(folder)
    total, others = seen.get["rows"], seen.get["others"]
    if others:
        raise ValueError(f"{others} of {total} rows are not of {year}")
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    written = spark.read.schema(kind).parquet(folder)
    by = [F.col("year") if timed else F.lit(None).cast("string").alias("year"), F.col(SOURCE).alias("file")]
    found = written.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    known = spark.createDataFrame(list((signatures or {}).items()), "file string, signature string")
    found = found.join(known, "file", "full_outer").withColumns({  # a file without rows is known too
        "rows": F.coalesce("rows", F.lit(0)), "year": F.when(F.col("rows").isNull(), F.lit(None if year is None else str(year))).otherwise(F.col("year"))})
    before = manifest(spark, path)
    number = 0 if before is None else (before.agg(F.max("number")).first()[0] or 0) + 1
    # a row without a file, so that a commit without rows ends what it replaces too
    marks = spark.createDataFrame([(str(year) if year is not None else None,)], "year string").select("year", F.lit(None).cast("string").alias("file"), F.lit(0).cast("long").alias("rows"), F.lit(None).cast("string").alias("signature"))
    entries = found.unionByName(marks).select(
        F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"), F.current_timestamp().alias("at"), F.lit(ends).alias("ends"),
        "year", "file", "rows", "signature", F.lit(kind.json()).alias("schema"))
    # one file, by a shuffle of these few rows: a coalesce would run the count and the join of all partitions inside one task
    entries = entries.repartition(1).persist()
    try:
        counted = entries.agg(F.sum("rows")).first()[0]
        if counted != total:
            raise RuntimeError(f"{path}: {total} rows were written, {counted} are there")
        (commit or _append)(entries, f"{path.rstrip('/')}/manifest")
    finally:
        entries.unpersist()
    return total


def _append(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def rows_by_year(spark: SparkSession, path: str) -> DataFrame:
    """``year``, ``rows`` of the table, from the manifest alone."""
    return live(spark, path).groupBy("year").agg(F.sum("rows").alias("rows"))


def clear(spark: SparkSession, path: str) -> int:
    """Empty the version folders that hold no row that counts any more; returns how many. Readers that started
    before may still want them, so this is a step of its own."""
    found = units(manifest(spark, path))
    state = found.groupBy("version").agg(F.bool_or("alive").alias("used"), F.first("schema").alias("schema"), F.sum("rows").alias("rows"))
    old = state.filter("not used and rows > 0").collect()
    for r in old:
        schema = T.StructType.fromJson(json.loads(r.schema))
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{_data(path)}/v={r.version}")
    return len(old)
