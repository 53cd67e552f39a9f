"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases: each phrase is the longest one seen before, with one more
character. Two texts share phrases as far as one would help to compress the other. The set of a
text's phrases is kept as a signature of minimum hashes; the share of equal minima estimates how
much of the two sets is common.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import picked
from .words import mix, powers

HASHES = 64
_BASE = 0xA24BAED4963EE407 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_random = np.random.default_rng(41)
_A = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, HASHES, dtype=np.uint64)


def phrases(text: str, known: set[str], ends: list[int], at: int = 0) -> None:
    """Add the phrases of ``text`` to ``known``, and where each ends, counted from ``at``, to ``ends``.

    What is left over at the end is a phrase that was seen before.
    """
    phrase = ""
    for at, c in enumerate(text, at + 1):
        phrase += c
        if phrase not in known:
            known.add(phrase)
            ends.append(at)
            phrase = ""


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """A 64-bit hash of every phrase, given where they end; a rest that was seen before is left out."""
    if not ends:
        return np.zeros(0, np.uint64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(mix(code + np.uint64(1)) * powers(_BASE, len(code)), out=sums[1:])
    stop = np.array(ends)
    start = np.concatenate([[0], stop[:-1]])
    return mix((sums[stop] - sums[start]) * powers(_INVERSE, len(code))[start])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest upper half of a*x+b modulo 2**64 over all phrases, for each hash function."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(low, (hashes[at:at + 512, None] * _A + _B).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def fingerprint(text: str) -> np.ndarray:
    ends: list[int] = []
    phrases(text, set(), ends)
    return signature(phrase_hashes(text, ends))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal minima. Two empty texts are alike; their signatures are the same."""
    return float((a == b).mean())


def edited(text: str, other: str) -> str:
    """The last half of ``text`` gives way to as much of ``other``'s beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


class Parsed:
    """A text with its fingerprint, and its parse up to the last whole phrase of the half that an
    edit leaves alone."""

    def __init__(self, name: int | None, text: str):
        self.name, self.text = name, text
        self.known: set[str] = set()
        self.ends: list[int] = []
        phrases(text[:len(text) - len(text) // 2], self.known, self.ends)
        self.at = self.ends[-1] if self.ends else 0
        known, ends = set(self.known), list(self.ends)
        phrases(text[self.at:], known, ends, self.at)
        self.print = signature(phrase_hashes(text, ends))

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The edited text and its fingerprint."""
        changed = edited(self.text, other)
        ends = list(self.ends)
        phrases(changed[self.at:], set(self.known), ends, self.at)
        return changed, signature(phrase_hashes(changed, ends))


def as_text(print_: np.ndarray) -> str:
    return print_.tobytes().hex()


def dealt(docs: DataFrame) -> DataFrame:
    """``bucket``, ``id``, ``text``, ``guest``: rows in buckets of neighbouring ids.

    The next document in descending order of id is in the same bucket, or it is the first one of
    the nearest bucket below that has rows, which comes along as a guest; below the last bucket
    begins the first again. Only the buckets' bounds and largest ids pass through the driver: a
    few numbers for each partition.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("key", F.coalesce("id", F.lit(-2**63)))
    bounds = keyed.select(F.percentile_approx("key", [k / parts for k in range(1, parts)] or [0.5], 10_000).alias("q")).first().q or []
    splits = [-float("inf"), *sorted({float(b) for b in bounds}), float("inf")]
    keyed = keyed.withColumn("place", F.col("key").cast("double"))
    keyed = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(keyed).withColumn("bucket", F.col("bucket").cast("int"))
    tops = {r.bucket: r.top for r in keyed.groupBy("bucket").agg(F.max("key").alias("top")).collect()}
    order = sorted(tops)
    # the largest id of a bucket also goes to the bucket above it that has rows, that of the last to the first
    above = spark.createDataFrame(
        [(b, tops[b], order[(k + 1) % len(order)]) for k, b in enumerate(order)], "own int, top long, target int")
    rows = keyed.select("bucket", "id", "text", F.lit(False).alias("guest"), "key")
    guests = rows.join(F.broadcast(above), (F.col("bucket") == F.col("own")) & (F.col("key") == F.col("top")))
    guests = guests.select(F.col("target").alias("bucket"), "id", "text", F.lit(True).alias("guest"), "key")
    together = rows.unionByName(guests).repartitionByRange(max(parts, 1), "bucket")
    # the first row of tied ids is the one that others see as next, so guests are ordered alike
    return together.sortWithinPartitions("bucket", "guest", F.desc("key"), "text").drop("key")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``: one row for each row of ``docs``.

    The next document is that of the next smaller id, for the smallest id that of the largest;
    rows without an id come last, rows of one id in the order of their texts, and a table of one
    row is its own next. A null text is empty; an empty text has the fingerprint without phrases.
    Repeated rows give repeated fingerprints. Whole texts are parsed; other columns play no part;
    an empty table gives an empty result.
    """

    def measured(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

    def finish(held: Parsed, following: Parsed) -> tuple:
        changed, changed_print = held.edited(following.text)
        digest = sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (held.name, len(held.text), digest, as_text(held.print), as_text(changed_print),
                likeness(held.print, changed_print), likeness(held.print, following.print))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Parsed | None = None  # the row whose next one is awaited
        for batch in batches:
            out: list[tuple] = []
            for name, text, guest in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "guest"))):
                if guest and held is None:
                    continue  # another row of the guest's id
                now = Parsed(name, text or "")
                if held is not None:
                    out.append(finish(held, now))
                held = None if guest else now
            yield measured(out)

    docs = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    if docs.isEmpty():
        return docs.mapInArrow(run, _SCHEMA)
    return dealt(docs).mapInArrow(run, _SCHEMA)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
