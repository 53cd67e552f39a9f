"""Near-duplicate documents: MinHash signatures, banding, exact confirmation, components.

1. Every text becomes its set of word shingles (64-bit hashes) and a signature of many universal
   hash minima. Documents with equal sets are one node from here on, named by their smallest id.
2. Nodes that agree on a band of the signature share a bucket. Each member is compared with the
   bucket's smallest node: signature first, then the full sets. Links are joined to components.
3. That leaves pairs of one bucket that lie in different components. A group of copies is one
   component after step 2 and costs nothing here. The others are compared in bounded blocks, the
   members outside the bucket's largest component against everyone, but only where the shingles
   that a document has in common with any other leave room for a link: an edited copy that is too
   far from all others has too many shingles of its own and drops out first. Signatures and full
   sets are compared where the blocks lie; only links leave them.

No link between different texts is lost but by the banding itself: with 32 bands of 4, a pair at a
similarity of 0.8 misses all bands with a probability of 5e-8, and the signature test with 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import by_ids, mapped, picked, stored
from .words import shingle_set, slices, utf8


@dataclass(frozen=True)
class Rule:
    """Shingle size, similarity in percent, bands and hashes in a band, members in a block."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    block: int = 256
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def agreements(self) -> int:
        """Fewest equal minima of a pair at the similarity, six deviations below the mean."""
        p = self.percent / 100
        return max(0, int(self.hashes * p - 6 * (self.hashes * p * (1 - p)) ** 0.5))


def signature(shingles: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest upper half of a*x+b modulo 2**64, for each (a, b)."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        part = shingles[at:at + 256, None] * multipliers + offsets
        np.minimum(low, (part >> np.uint64(32)).min(axis=0), out=low)
    return low.astype(np.uint16)


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """``id``, ``n`` (set size), ``set_key`` (digest of the set) and ``sig`` of ``id``, ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(rule.seed)
        a = random.integers(0, 2**63, rule.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = random.integers(0, 2**63, rule.hashes, dtype=np.uint64)
        for batch in slices(batches):
            n, keys, sigs = [], [], []
            for text in utf8(batch.column("text")):
                found = shingle_set(text, rule.words)
                n.append(len(found))
                keys.append(blake2b(found.tobytes(), digest_size=16).digest())
                sigs.append(signature(found, a, b).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                ["id", "n", "set_key", "sig"])

    return mapped(docs, run, "id long, n long, set_key binary, sig binary")


def buckets(nodes: DataFrame, rule: Rule) -> DataFrame:
    """``key``, ``band``, ``id``, ``pivot`` of every node that shares a bucket, as a written table."""
    width = 2 * rule.rows
    rows = nodes.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(rule.bands - 1))).alias("band")).select(
        F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("key"), "band", "id")
    shared = rows.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot != last")
    return stored(rows.join(shared.drop("last"), "key"), "buckets")


def alike(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose signatures and set sizes allow a link."""
    left = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    near = (100 * F.least("na", "nb") >= rule.percent * F.greatest("na", "nb"))
    both = pairs.join(right, "b").join(left, "a").filter(near).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            same = (_minima(batch.column("sa"), rule) == _minima(batch.column("sb"), rule)).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= rule.agreements))

    return mapped(both, run, "a long, b long")


def _minima(column: pa.Array, rule: Rule) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(len(column), rule.hashes)


def common_shingles(nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """``id``, ``c``: how many shingles of a node occur in another node of these too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text, rule.words) for text in utf8(batch.column("text"))]
            ids = np.repeat(batch.column("id").to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], ["id", "x"])

    rows = mapped(by_ids(docs, nodes, "id", "left_semi"), run, "id long, x long")
    alone = rows.groupBy("x").agg(F.count(F.lit(1)).alias("k"), F.min("id").alias("id")).filter("k = 1")
    alone = alone.groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    sizes = nodes.groupBy("id").agg(F.sum("n").alias("n"))
    return sizes.join(alone, "id", "left").select("id", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"))


def linked(own: np.ndarray, others: list[np.ndarray], rule: Rule) -> np.ndarray:
    """Which of the other sets are similar enough to ``own``; sets are sorted and not empty."""
    size = np.array([len(x) for x in others])
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, every), len(own) - 1)
    common = np.add.reduceat(own[place] == every, np.cumsum(size) - size, dtype=np.int64)
    return 100 * common >= rule.percent * (len(own) + size - common)


def full_sets(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """``id``, ``set_key``, ``members``: the shingle sets of the rows with one of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text, rule.words).tobytes() for text in utf8(batch.column("text"))]
            keys = [blake2b(x, digest_size=16).digest() for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["id", "set_key", "members"])

    return mapped(by_ids(docs, ids, "id", "left_semi"), run, "id long, set_key binary, members binary")


def confirmed(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a``, ``b`` whose full shingle sets are similar enough; a written table."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                good.append(bool(linked(x, [y], rule)[0]))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = stored(full_sets(docs, wanted, rule), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    links = mapped(pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y"), link, "a long, b long")
    return stored(links, "links")


def strays(shared: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a``, ``b`` between members of one bucket that lie in different components.

    Pairs with the bucket's pivot were compared before. A pair is compared once, in the first band
    it shares. Blocks bound the rows of a task's group; a larger bucket is dealt over many of them.
    """
    comp = F.coalesce("b", "id").alias("comp")
    rows = shared.filter("id != pivot").join(labels.withColumnRenamed("a", "id"), "id", "left").select("key", "band", "id", comp)
    parts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = (parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("total"),
                                      F.max(F.struct("c", "comp")).alias("top")).filter("parts > 1"))
    blocks = lambda n: F.ceil(n / F.lit(rule.block)).cast("int")
    mixed = mixed.select("key", F.col("top.comp").alias("top"), blocks(F.col("total")).alias("all_blocks"),
                         blocks(F.col("total") - F.col("top.c")).alias("few_blocks"))
    rows = stored(rows.join(mixed, "key"), "mixed")
    nodes = nodes.join(rows.select("id").distinct(), "id", "left_semi")
    nodes = stored(nodes.join(common_shingles(nodes, docs, rule), "id").filter(100 * F.col("c") >= rule.percent * F.col("n")), "open-nodes")
    rows = stored(rows.join(nodes.select("id").distinct(), "id", "left_semi"), "open-rows")
    slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["key", "band", "id", "comp"]
    few = rows.filter("comp != top").select(*keep, F.lit(True).alias("few"), slot("few_blocks").alias("i"), every("all_blocks").alias("j"))
    many = rows.select(*keep, F.lit(False).alias("few"), every("few_blocks").alias("i"), slot("all_blocks").alias("j"))
    known = nodes.join(full_sets(docs, nodes, rule), ["id", "set_key"]).drop("set_key").distinct()
    p = rule.percent

    def compare(group: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        out = []
        rest = np.flatnonzero(~group["few"])
        for k in np.flatnonzero(group["few"]):
            n, c, other = group["n"][k], group["c"][k], group["n"][rest]
            fits = rest[(group["comp"][rest] != group["comp"][k]) & (100 * np.minimum(n, other) >= p * np.maximum(n, other))
                        & ((100 + p) * np.minimum(c, group["c"][rest]) >= p * (n + other))]
            same = group["sig"][fits] == group["sig"][k]
            fits, same = fits[ok := same.sum(axis=1) >= rule.agreements], same[ok]
            first = same.reshape(len(fits), rule.bands, rule.rows).all(axis=2).argmax(axis=1)
            fits = fits[first == group["band"][k]]
            if len(fits):
                good = linked(group["members"][k], list(group["members"][fits]), rule)
                out += [(group["id"][k], group["id"][m]) for m in fits[good]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["key", "i", "j"], rule):
            if found := compare(group):
                low, high = np.sort(np.array(found, np.int64), axis=1).T
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    blocked = few.unionByName(many).join(known, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return stored(mapped(blocked, run, "a long, b long"), "links")


def _column(batch: pa.RecordBatch, name: str, rule: Rule) -> np.ndarray:
    column = batch.column(name)
    if name == "sig":
        return _minima(column, rule)
    if name == "members":
        out = np.empty(len(column), object)
        for k, value in enumerate(column):
            out[k] = np.frombuffer(value.as_py(), np.uint64)  # a copy, so that no batch is kept alive
        return out
    return column.to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch], by: list[str], rule: Rule) -> Iterator[dict[str, np.ndarray]]:
    """Rows that agree on ``by``, together, from sorted batches; one such group and one slice are held at a time."""
    held: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        new = {c: _column(batch, c, rule) for c in batch.schema.names}
        held = {c: np.concatenate([held[c], v]) for c, v in new.items()} if held else new
        ends = np.flatnonzero(np.any([held[c][1:] != held[c][:-1] for c in by], axis=0)) + 1
        for lo, hi in zip([0, *ends[:-1]], ends):
            yield {c: v[lo:hi] for c, v in held.items()}
        if len(ends):
            held = {c: v[ends[-1]:] for c, v in held.items()}
    if held and len(held["id"]):
        yield held


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row for each row of ``docs``.

    Words and shingles are those of :mod:`words`: A-Z lower-cased, split at ASCII white space.
    Fewer words than a shingle count as one run of words. Null, empty and blank texts have an
    empty set and are linked with nothing. Repeated rows fall into one component; rows that
    share an id but not a text are compared by each text and carry the id of their component.
    A row without an id keeps its place with a null component and is kept. Other columns of
    ``docs`` play no part; an empty table gives an empty result.
    """
    docs = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    rows = stored(signatures(docs, rule), "signatures")
    known = rows.filter("id is not null and n > 0")
    nodes = stored(known.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    shared = buckets(nodes, rule)
    star = shared.filter("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = confirmed(alike(star, nodes, rule), docs, rule)
    labels = components(links)
    labels = components(labels.unionByName(strays(shared, labels, nodes, docs, rule)))
    named = nodes.select("set_key", "id").join(labels.withColumnRenamed("a", "id"), "id", "left")
    named = named.select("set_key", F.coalesce("b", "id").alias("component"))
    # rows with an empty set stay where they are: a join would bring them all into one task
    linked = rows.filter("n > 0").join(named, "set_key", "left").unionByName(rows.filter("n = 0"), allowMissingColumns=True)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return linked.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
