"""Headline timings as one JSON line: the job that builds all layers (one cold run), then the
steps of that job from the given tables and the queries that read the built tables (the better
of two runs; results go to a sink that takes every column and keeps nothing)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from paylens.contract.registry import Data, QUERIES
from paylens.session import session

HEADLINE = (
    "end_to_end_national", "p01_stage_spending", "p02_stage_utilization", "j01_enrich_spending",
    "j02_enrich_utilization", "w01_latest_per_key", "q09_validate",
    "a01_specialty_benchmark", "a02_drug_spending", "a03_kpi_overview", "a04_national_benchmark",
    "a07_provider_year", "a08_provider_risk", "a14_top_drugs_from_fact", "a17_top_drugs", "w03_pareto",
    "t05_top_outliers", "p19_provider_detail", "j07_high_withhold_preview", "m08_roc_auc",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", "bench", **{
        "spark_sql_shuffle_partitions": cpus, "spark_driver_memory": "16g", "spark_ui_enabled": "false",
        "spark_log_level": "ERROR", "spark_checkpoint_dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    })
    data = Data(spark, path)
    data.given("lineitem").count()  # start-up is not part of any query
    times = {"s15_build_layers": seconds(lambda: data.house)}
    for name in HEADLINE:
        times[name] = min(
            seconds(lambda: QUERIES[name].run(data).write.format("noop").mode("overwrite").save()) for _ in range(2)
        )
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(path.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
