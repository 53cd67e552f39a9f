"""Token files: ids of all documents in ascending doc_id order, in entropy-coded blocks.

A file set is a folder of Parquet files whose rows are blocks: whole documents, the ids coded by
:mod:`rans` with one table for the whole set, and an index of the documents inside. Blocks are
independent, so any task can decode any of them, and a lost executor costs the blocks it held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rans
from .store import mapped, picked, stored
from .tokens import encoder

BLOCK = 1 << 18  # a block is closed once it has so many ids
_ROWS = "part int, at long, n long, ids binary, doc_ids binary, known binary, sizes binary"


def blocked(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ordered documents in blocks: the partition, the ids before a block in it, and its documents, each
    with its text's ids and the end id as little-endian integers.

    One step: as two, every task would hold two Python workers, and the ids would pass between them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        width, end = coder.dtype.itemsize, np.array([end_id], coder.dtype).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int | None] = []
        size = 0

        def close() -> pa.RecordBatch:
            known = np.array([name is not None for name in names], np.uint8)
            values = [part, at, size, b"".join(ids), np.array([name or 0 for name in names], "<i8").tobytes(), known.tobytes(),
                      np.array([len(i) // width for i in ids], "<i8").tobytes()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              ["part", "at", "n", "ids", "doc_ids", "known", "sizes"])

        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()  # one at a time: a batch of long texts is held once only
                found = coder.encode(text) + end if text else end
                names.append(name)
                ids.append(found)
                size += len(found) // width
                if size >= BLOCK:
                    yield close()
                    at, size, ids, names = at + size, 0, [], []
        if names:
            yield close()

    return mapped(docs, run, _ROWS)


def counted(blocks: DataFrame, width: int) -> DataFrame:
    """``symbol``, ``count`` over all blocks; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"))
                if len(found) > len(total):
                    total, found = found, total
                total[:len(found)] += found
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["symbol", "count"])

    return mapped(blocks.select("ids"), run, "symbol long, count long").groupBy("symbol").agg(F.sum("count").alias("count"))


def coded(blocks: DataFrame, counts: np.ndarray, starts: dict[int, int], width: int) -> DataFrame:
    """Blocks as they are written; ``starts`` has the ids before each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table.of(counts)
        for batch in batches:
            for lo in range(0, len(batch), 8):
                rows = batch.slice(lo, 8)
                ids = [np.frombuffer(v.as_buffer(), f"<u{width}") for v in rows.column("ids")]
                start = [starts[p] + a for p, a in zip(rows.column("part").to_pylist(), rows.column("at").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(start, pa.int64()), rows.column("n"), rows.column("doc_ids"), rows.column("known"),
                     rows.column("sizes"), pa.array(rans.encode_all(ids, table), pa.binary())],
                    ["start", "n", "doc_ids", "known", "sizes", "block"])

    return mapped(blocks, run, "start long, n long, doc_ids binary, known binary, sizes binary, block binary")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts of ``docs`` to the new folder ``path``.

    Documents are in ascending order of id, those without an id first, ties in the order of their
    texts; each ends with ``end_id``. A null or empty text has the end id alone. Repeated
    rows are written each time. Other columns play no part; an empty table gives a set without
    documents. The vocabulary file must be at the same place on all hosts.
    """
    width = encoder(vocabulary).dtype.itemsize
    rows = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    # texts are dealt first: the bounds of the ranges come from a pass of their own over what is dealt
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    blocks = stored(blocked(ordered, vocabulary, end_id), "token-blocks")
    counts = counted(blocks, width).collect()  # no more rows than the vocabulary has entries
    table = np.zeros(max((r.symbol for r in counts), default=-1) + 1, np.int64)
    for r in counts:
        table[r.symbol] = r["count"]
    starts, total = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row for each partition
        starts[r.part], total = total, total + r.n
    coded(blocks, table, starts, width).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    seen = np.flatnonzero(table)
    spark.createDataFrame([(s, int(table[s])) for s in seen.tolist()], "symbol long, count long").coalesce(1).write.parquet(f"{path}/table")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` of every document of a set; ``ids`` are
    little-endian unsigned 32-bit integers. Raises where a checksum does not hold."""
    counts = {r.symbol: r["count"] for r in spark.read.parquet(f"{path}/table").collect()}
    table = np.zeros(max(counts, default=-1) + 1, np.int64)
    table[list(counts)] = list(counts.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.of(table)
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode(row["block"], shared).astype("<u4").tobytes()
                size = np.frombuffer(row["sizes"], "<i8")
                ends = np.cumsum(size)
                known = np.frombuffer(row["known"], np.uint8) == 0
                names = pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=known)
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(row["start"] + ends - size), pa.array(size),
                     pa.array([ids[4 * a:4 * b] for a, b in zip(ends - size, ends)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return mapped(spark.read.parquet(f"{path}/blocks"), run, "doc_id long, start long, n_tokens long, ids binary")
