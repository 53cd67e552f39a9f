"""Tables that cut lineage: written to the cluster's shared checkpoint folder and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table. Lost executors cost a re-read, not a re-computation."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the given new names, so that no other column can clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def by_ids(df: DataFrame, ids: DataFrame, column: str, how: str, limit: int = 1_000_000) -> DataFrame:
    """``df`` with (``left_semi``) or without (``left_anti``) the rows whose ``column`` is among
    ``ids.id``. Rows stay where they are while the ids are few enough to broadcast, which is
    counted first; beyond that they are shuffled."""
    ids = stored(ids.select(F.col("id").alias("__id")).distinct(), "ids")
    return df.join(F.broadcast(ids) if ids.count() <= limit else ids, F.col(f"`{column}`") == F.col("__id"), how)


ARROW_ROWS = 1000  # texts are long: batches of Spark's default size take tens of MB on either side of every task


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of at most :data:`ARROW_ROWS` rows, a setting that the session keeps."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ARROW_ROWS:
        conf.set(name, ARROW_ROWS)
    return df.mapInArrow(run, schema)
