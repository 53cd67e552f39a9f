"""Resumable load: a checkpointed file source finds new files, the batch loader loads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import list_files, load_files, route
from ..sources.raw import changed_files, now, table_path, write_raw


def resume_load(
    spark: SparkSession, folder: str, root: str, checkpoint: str, files_per_batch: int = 100
) -> int:
    """Load the files of ``folder`` that earlier runs have not committed; returns how many.

    The stream carries file paths only; its checkpoint records which files are done. A
    micro-batch hands its paths to the batch loader, which writes whole year/file folders:
    a batch that is run again after a failure replaces its own output, so each file ends
    up loaded exactly once. The checkpoint knows files by their path only: one that was replaced since
    it was loaded is found by the length and time in its table's manifest, and loaded again.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{folder.rstrip('/')}/*.csv")
        .select(F.col("path"))
    )
    done = 0

    changed = changed_files(spark, [r.path for r in list_files(spark, folder).collect()], root)

    def load(batch: DataFrame, _: int) -> None:
        by_table: dict[str, list[str]] = {}
        for row in batch.collect():  # at most files_per_batch paths
            by_table.setdefault(route(row.path)[0], []).append(row.path)
        for table, paths in by_table.items():
            put(table, sorted(paths))

    def put(table: str, paths: list[str]) -> None:
        nonlocal done
        write_raw(load_files(spark, paths, now()), table_path(root, table), False, paths)
        done += len(paths)

    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    for path in changed:
        put(route(path)[0], [path])
    return done
