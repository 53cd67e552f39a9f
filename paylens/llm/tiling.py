"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a benchmark item are found by rolling Karp-Rabin hashes
of a few words (the seeds), joined with the seeds of all items. Neighbouring seeds on a diagonal
make up maximal matches. The longest match is marked first, then the longest of what is left
unmarked in both texts, and so on, until nothing of seed length remains: the tiles. The share of
an item's words under tiles tells how much of the item the document holds, in any order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, picked
from .words import NOT_LETTERS, rolling, utf8, word_hashes

SCHEMA = "doc_id long, item_id long, covered long, n_words long, coverage double, longest long, tiles string"


@dataclass(frozen=True)
class Tiling:
    """Words of a seed and of the shortest tile, least share of an item's words, and how many
    bytes of items are held in a task at a time."""

    seed: int = 5
    coverage: float = 0.5
    block_bytes: int = 16 << 20


class Items:
    """The seeds of a block of items: by item, and sorted by hash."""

    def __init__(self, ids: list[int | None], texts: pa.Array, seed: int):
        words = [_words(text) for text in utf8(pc.utf8_lower(texts))]
        self.ids, self.sizes, self.seed = ids, [len(w) for w in words], seed
        self.seeds = [rolling(w, seed) for w in words]
        every = np.concatenate(self.seeds) if self.seeds else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.seeds)), [len(h) for h in self.seeds])
        order = np.argsort(every, kind="stable")
        self.hashes, self.owner = every[order], owner[order]

    def sharing(self, seeds: np.ndarray) -> np.ndarray:
        """The items that have any of the seeds, in order."""
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        low = np.searchsorted(self.hashes, seeds, "left")
        shared = np.unique(seeds[self.hashes[np.minimum(low, len(self.hashes) - 1)] == seeds])
        if not len(shared):
            return np.zeros(0, np.int64)
        low = np.searchsorted(self.hashes, shared, "left")
        count = np.searchsorted(self.hashes, shared, "right") - low
        return np.unique(self.owner[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())])


def _words(text: bytes | memoryview) -> np.ndarray:
    return word_hashes(np.frombuffer(text, np.uint8), NOT_LETTERS)


def matches(doc: np.ndarray, item: np.ndarray, seed: int, chunk: int = 1 << 20) -> list[tuple[int, int, int]]:
    """Maximal matches as length, place in the document and in the item, from the seeds of both.

    Pairs of equal seeds are looked at in chunks, and only those are held that begin or end a run
    on their diagonal, so that texts that repeat themselves need no more memory than matches.
    """
    order = np.argsort(item, kind="stable")
    low = np.searchsorted(item[order], doc, "left")
    count = np.searchsorted(item[order], doc, "right") - low
    at = np.flatnonzero(count)
    low, count = low[at], count[at]
    total = np.cumsum(count)
    begins, ends = [], []
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - count[lo] + chunk, "right")))
        n = count[lo:hi]
        i = order[np.repeat(low[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        d = np.repeat(at[lo:hi], n)
        goes_on = (d > 0) & (i > 0) & (doc[d - 1] == item[i - 1])
        begins.append(np.stack([d - i, d])[:, ~goes_on])
        after = (d + 1 < len(doc)) & (i + 1 < len(item))
        goes_on = after & (doc[np.where(after, d + 1, 0)] == item[np.where(after, i + 1, 0)])
        ends.append(np.stack([d - i, d])[:, ~goes_on])
        lo = hi
    if not begins:
        return []
    (side, first), (other, last) = (np.concatenate(x, axis=1) for x in (begins, ends))
    one, two = np.lexsort((first, side)), np.lexsort((last, other))
    first, side, last = first[one], side[one], last[two]
    return list(zip((last - first + seed).tolist(), first.tolist(), (first - side).tolist()))


def tile(found: list[tuple[int, int, int]], n_doc: int, n_item: int, seed: int) -> list[tuple[int, int, int]]:
    """Tiles (document, item, length), the longest first; ties by place in the document, then in
    the item. No word of either text is under two tiles."""
    heap = [(-length, doc, item) for length, doc, item in found]
    heapq.heapify(heap)
    in_item, in_doc = bytearray(n_item), bytearray(n_doc)
    left, tiles = n_item, []
    while heap and left >= seed:
        length, doc, item = heapq.heappop(heap)
        length = -length
        if 1 not in in_item[item:item + length] and 1 not in in_doc[doc:doc + length]:
            tiles.append((doc, item, length))
            in_item[item:item + length] = in_doc[doc:doc + length] = b"\1" * length
            left -= length
            continue
        # what is left of it between marks may still be a tile
        marked = np.frombuffer(in_item, np.uint8)[item:item + length] | np.frombuffer(in_doc, np.uint8)[doc:doc + length]
        stops = np.concatenate([[-1], np.flatnonzero(marked), [length]])
        for k in np.flatnonzero(np.diff(stops) > seed):
            heapq.heappush(heap, (int(stops[k] + 1 - stops[k + 1]), int(doc + stops[k] + 1), int(item + stops[k] + 1)))
    return tiles


def leaks(text: bytes | memoryview, items: Items, rule: Tiling) -> list[tuple]:
    """Items that the text covers far enough, in the order of the items."""
    seeds = rolling(_words(text), items.seed)
    out = []
    for k in items.sharing(seeds):
        n, own = items.sizes[k], items.seeds[k]
        places = np.flatnonzero(np.isin(own, seeds))
        # no tiling covers more words than all shared seeds together
        if np.minimum(np.diff(places), items.seed).sum() + items.seed < rule.coverage * n:
            continue
        tiles = tile(matches(seeds, own, items.seed), len(seeds) + items.seed - 1, n, items.seed)
        covered = sum(length for _, _, length in tiles)
        if covered >= rule.coverage * n:
            shown = ",".join(f"{d}:{i}:{length}" for d, i, length in sorted(tiles))
            out.append((items.ids[k], covered, n, covered / n, max(length for *_, length in tiles), shown))
    return out


def _against(docs: DataFrame, items: Items, rule: Tiling) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            texts = utf8(pc.utf8_lower(batch.column("text")))
            rows = [(name, *row) for name, text in zip(batch.column("id").to_pylist(), texts) for row in leaks(text, items, rule)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

    return mapped(docs, run, SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, rule: Tiling = Tiling(),
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``doc_id``, ``item_id``, ``covered``, ``n_words``, ``coverage``, ``longest``, ``tiles``: one
    row for each document and item whose words it covers to at least the given share.

    Words are runs of letters and digits, lower-cased; tiles are document word : item word :
    length. Items are the stated query set: they are measured first and sent to the tasks in
    blocks of bounded size, each against all documents; documents do not move. Null and empty
    texts, and items shorter than a seed, match nothing. Repeated rows on either side give
    repeated results; missing ids stay null; other columns play no part; an empty table on either
    side gives an empty result.
    """
    docs = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    return reduce(DataFrame.unionByName, (_against(docs, items, rule) for items in item_blocks(benchmark, rule, item_col, text_col)))


def item_blocks(benchmark: DataFrame, rule: Tiling, item_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The items in blocks of about ``block_bytes``; one block at a time passes through the driver."""
    items = picked(benchmark, id=item_col, text=text_col).withColumn("id", F.col("id").cast("long")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // rule.block_bytes))
    slot = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for k in range(blocks):
        part = items.filter(slot == k).orderBy("id", "text").toArrow()
        yield Items(part.column("id").to_pylist(), part.column("text"), rule.seed)


def without_leaks(docs: DataFrame, benchmark: DataFrame, rule: Tiling = Tiling(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`contaminated` has no item for; rows stay
    where they are."""
    for items in item_blocks(benchmark, rule):
        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = pc.utf8_lower(batch.column(batch.schema.get_field_index(text_col)))
                yield batch.filter(pa.array([not leaks(text, items, rule) for text in utf8(texts)], pa.bool_()))

        docs = mapped(docs, run, docs.schema)
    return docs
