"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for. Sizes are left to the cluster profile.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",  # a bad number in text must raise, not turn into null
    "spark.sql.session.timeZone": "UTC",
    # grouped medians keep one small histogram per group: stay hash based for longer
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def session(master: str | None = None, app: str = "paylens", **extra: str) -> SparkSession:
    """A session with :data:`CONF`; ``extra`` keys use ``_`` in place of ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CONF.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` names; without one,
    under the warehouse, which all hosts reach as well."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
