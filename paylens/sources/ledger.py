"""Build ledger: one appended row per state of a run, with its steps and measured rows."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as k


def record_run(spark: SparkSession, path: str, run: dict) -> str:
    """Append the present state of a run and return its id. States are never changed in
    place; :func:`current_runs` gives the newest one of each run."""
    if run["status"] not in k.RUN_STATUSES:
        raise ValueError(f"status must be one of {k.RUN_STATUSES}")
    now = datetime.now(timezone.utc)
    row = {
        "run_id": str(uuid4()), "started_at": now, "finished_at": None, "steps": [],
        "error_message": None, "triggered_by": "manual", **run, "recorded_at": now,
    }
    spark.createDataFrame([row], k.RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return row["run_id"]


def current_runs(ledger: DataFrame) -> DataFrame:
    """Newest state of each run."""
    columns = [x for x in ledger.columns if x != "run_id"]
    newest = F.max_by(F.struct(*columns), F.col("recorded_at"))
    return ledger.groupBy("run_id").agg(newest.alias("state")).select("run_id", "state.*")


def latest_runs(runs: DataFrame, n: int = 1) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(n)
