"""Ranked lexical search with bag deduplication.

The stated query items bring a vocabulary. Every document is reduced to the counts of these terms,
its bag, and to its length weight m. Documents with the same bag and the same m have the same score
for every item: they are one class, found by a hash and verified by the bag itself. Each class is
scored once, against the items that share a term with it. A class then stands for its members in
ascending order of their ids, of which a ranking of ``top`` documents can hold ``top`` at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import mapped, picked, stored
from .words import slices, utf8

# Bytes outside terms become blanks, A-Z becomes a-z; every byte beyond ASCII is in a term.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_CHUNK = 1 << 20
BAGS = "id long, n long, bag binary"
SCORES = "item long, score long, ids array<long>"


@dataclass(frozen=True)
class Search:
    """Ranks of an item, and the size of a block of items that is sent to the tasks at once."""

    top: int = 20
    block_bytes: int = 16 << 20


def terms(text: bytes | memoryview) -> Iterator[list[bytes]]:
    """The terms of a text, in order, in lists of a bounded size."""
    at = 0
    while at < len(text):
        part = bytes(text[at:at + _CHUNK]).translate(_CLEAN)
        if at + _CHUNK < len(text):
            cut = part.rfind(b" ") + 1
            if not cut:  # one term over the whole chunk and more
                end = at + _CHUNK
                while end < len(text) and _CLEAN[text[end]] != 32:
                    end += 1
                part, cut = bytes(text[at:end]).translate(_CLEAN), end - at
            part = part[:cut]
        at += len(part)
        yield part.split()


class Vocabulary:
    """The terms of a block of items, numbered, and how often each item has each of them."""

    def __init__(self, names: list[int | None], texts: list[bytes | memoryview]):
        bags = [Counter(t for part in terms(text) for t in part) for text in texts]
        self.names = names
        self.place = {t: k for k, t in enumerate(sorted(set().union(*bags)))}
        rows = sorted((self.place[t], item, times) for item, bag in enumerate(bags) for t, times in bag.items())
        of, item, times = np.array(rows, np.int64).reshape(-1, 3).T
        self.start = np.searchsorted(of, np.arange(len(self.place) + 1))
        self.item, self.times = item, times

    def bag(self, text: bytes | memoryview) -> tuple[int, bytes]:
        """Number of terms of a text, and its known terms and their counts as 64-bit integers."""
        n, found = 0, Counter()
        for part in terms(text):
            n += len(part)
            found.update(map(self.place.get, part))
        found.pop(None, None)
        return n, np.array(sorted(found.items()), "<i8").T.tobytes() if found else b""


def bags(docs: DataFrame, words: Vocabulary) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, found = zip(*map(words.bag, utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(found, pa.binary())], ["id", "n", "bag"])

    return mapped(docs, run, BAGS)


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of the ``size`` terms occurs; one number for each term leaves Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in slices(batches):
            held = [np.frombuffer(bag, "<i8")[:len(bag) // 16] for bag in batch.column("bag").to_pylist()]
            total += np.bincount(np.concatenate(held), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    counts = mapped(rows.select("bag"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    return out


def classes(rows: DataFrame, documents: int, length: int, top: int) -> DataFrame:
    """``bag``, ``m``, ``ids``: the classes of rows with a bag, each with its ``top`` smallest ids, a missing id last.

    The rank filter runs before the shuffle too, so a class of any size sends ``top`` rows from a task.
    """
    m = F.expr(f"75 + (25 * n * cast({documents} as decimal(18,0))) div {max(1, length)}")  # more than 64 bits on the way
    known = rows.filter("length(bag) > 0").select("id", "bag", m.cast("long").alias("m"))
    known = known.withColumn("hash", F.xxhash64("bag", "m"))
    members = Window.partitionBy("hash", "bag", "m").orderBy(F.col("id").asc_nulls_last())
    first = known.withColumn("place", F.row_number().over(members)).filter(F.col("place") <= top)
    return first.groupBy("hash", "bag", "m").agg(F.collect_list(F.struct("place", "id")).alias("ids")).select(
        "bag", "m", F.transform(F.array_sort("ids"), lambda x: x.id).alias("ids"))


def best(items: np.ndarray, scores: np.ndarray, first: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best of each item: by score, then by the smallest id."""
    order = np.lexsort((first, -scores, items))
    ordered = items[order]
    begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)]))
    return order[rank < top]


def scored(groups: DataFrame, words: Vocabulary, weights: np.ndarray, top: int) -> DataFrame:
    """``item`` (its place), ``score``, ``ids``: of each task the ``top`` best classes of each item.

    A class that is not among the best ``top`` of a task, by score and smallest id, is preceded by
    ``top`` documents of other classes, so it cannot be in the result.
    """
    count = len(words.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        items, scores, first, held = none, none, none, []
        for batch in slices(batches, max(1, min(256, 4_000_000 // max(1, count)))):
            found = [np.frombuffer(bag, "<i8").reshape(2, -1) for bag in batch.column("bag").to_pylist()]
            owner = np.repeat(np.arange(len(found)), [b.shape[1] for b in found])
            term, tf = np.concatenate(found, axis=1)
            m = batch.column("m").to_numpy()[owner]
            value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            spread = words.start[term + 1] - words.start[term]
            post = np.repeat(words.start[term] - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())
            grid = np.zeros(len(found) * count, np.int64)
            np.add.at(grid, np.repeat(owner, spread) * count + words.item[post], np.repeat(value, spread) * words.times[post])
            hit = np.flatnonzero(grid > 0)
            ids = batch.column("ids").to_pylist()
            low = np.array([np.iinfo(np.int64).max if x[0] is None else x[0] for x in ids], np.int64)
            items, scores = np.concatenate([items, hit % count]), np.concatenate([scores, grid[hit]])
            first, held = np.concatenate([first, low[hit // count]]), held + [ids[k] for k in hit // count]
            keep = best(items, scores, first, top)
            items, scores, first, held = items[keep], scores[keep], first[keep], [held[k] for k in keep]
        yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(scores), pa.array(held, pa.list_(pa.int64()))], ["item", "score", "ids"])

    return mapped(groups, run, SCORES)


def blocks(items: DataFrame, rule: Search) -> Iterator[Vocabulary]:
    """The items in blocks of about ``block_bytes``; one block at a time passes through the driver."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // rule.block_bytes))
    slot = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    for k in range(parts):
        part = items.filter(slot == k).orderBy("id", "text").toArrow()
        yield Vocabulary(part.column("id").to_pylist(), list(utf8(part.column("text"))))


def ranked(docs: DataFrame, benchmark: DataFrame, rule: Search = Search(),
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the best documents of every item.

    Terms are runs of letters, digits and all characters beyond ASCII; only A-Z are lower-cased. The score adds up
    w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included, with
    w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 75 + 25 n N div L, in 64-bit integers; N counts the
    documents with a term, L their terms, n the document's terms, df the documents with the term.
    Documents with the same score go by ascending id; a missing id comes last. Repeated rows are documents of
    their own on either side. Null, empty and term-less texts match nothing and are not counted in N. Other
    columns play no part; an empty table on either side gives an empty result.

    Items are the stated query set: they are measured first and sent to the tasks in blocks of bounded size.
    """
    docs = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    items = picked(benchmark, id=item_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    return reduce(DataFrame.unionByName, (_ranked(docs, words, rule) for words in blocks(items, rule)))


def _ranked(docs: DataFrame, words: Vocabulary, rule: Search) -> DataFrame:
    rows = stored(bags(docs, words), "bags")
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(rows, len(words.place)).tolist()
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * k + 1))) for k in df], np.int64)
    found = scored(classes(rows, documents, length, rule.top), words, weights, rule.top)
    best_classes = Window.partitionBy("item").orderBy(F.desc("score"), F.expr("ids[0]").asc_nulls_last())
    few = found.withColumn("place", F.row_number().over(best_classes)).filter(F.col("place") <= rule.top)
    members = few.select("item", "score", F.explode("ids").alias("doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    last = members.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rule.top)
    names = docs.sparkSession.createDataFrame(list(enumerate(words.names)), "item int, item_id long")
    return last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def oracle() -> str:
    """The result of the query over ``documents`` and ``benchmark`` in DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = lambda x: f"regexp_extract_all(translate(coalesce({x}, ''), '{upper}', '{lower}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""with d as materialized (select row_number() over () as r, doc_id, {split('text')} as terms from documents),
        i as materialized (select row_number() over () as i, item_id, {split('text')} as terms from benchmark),
        whole as (select count(*) filter (len(terms) > 0) as docs, sum(len(terms))::bigint as length from d),
        q as materialized (select i, term, count(*) as times from (select i, unnest(terms) as term from i) group by 1, 2),
        t as materialized (select r, term, count(*) as tf from (select r, unnest(terms) as term from d) where term in (select term from q) group by 1, 2),
        w as materialized (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
            from (select term, count(*) as df from t group by 1), whole),
        m as materialized (select r, doc_id, 100 - 25 + (25 * len(terms) * docs) // length as m from d, whole where len(terms) > 0),
        s as (select i, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)) * times)::bigint as score
            from q join t using (term) join w using (term) join m using (r) group by 1, 2),
        ordered as (select item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id nulls last) as rank
            from s join m using (r) join i using (i) where score > 0)
        select item_id, rank::int as rank, doc_id, score from ordered where rank <= {Search().top}"""
