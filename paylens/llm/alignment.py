"""Alignment of the tokens of two tokenizers by lockstep merging.

Both tokenizations of a text cover the same bytes. Two pointers walk over their tokens: where both
tokens end at the same byte, they are linked and the text is cut; otherwise the pointer whose token
ends first moves on. One numpy vector holds the pointers of all documents of a batch: a step moves
all of them at once, emits their links and cuts, and drops the documents that have ended.

How often two ids are linked is counted over all documents, and each document's links are held
against these counts.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .store import mapped, picked, stored

SCHEMA = ("row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<long>")
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*\Z")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")


@dataclass(frozen=True)
class Align:
    """Bytes of text that are merged at once, tokens of a lane, pairs that are broadcast."""

    batch_bytes: int = 1 << 20
    lane: int = 512
    few: int = 1_000_000


class Pair:
    """The two tokenizers and the bytes of each of their tokens.

    ``ranks`` is the first tokenizer's vocabulary as ranks, with the pattern that it cuts texts by. Texts of plain Latin letters, digits and
    marks go through these, which gives the same ids several times faster; any other text goes through the tokenizer itself. That
    the ranks are the tokenizer's own tokens is checked when they are loaded, and equal ids by the tests.
    """

    def __init__(self, a_path: str, b_path: str, ranks: tuple[str, str] | None = None):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}  # fixed values of byte-level tokens
        shown |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in shown)}
        back = {c: b for b, c in shown.items()}
        names = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.a_bytes = [bytes(back[c] for c in name) if all(c in back for c in name) else name.encode() for name in names]
        parts = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.match(p)) else p.replace("▁", " ").encode() for p in parts]
        self.a_size, self.b_size = (np.array([len(x) for x in y], np.int32) for y in (self.a_bytes, self.b_bytes))
        self.apart = not any(re.search("[^▁]▁", p) for p in parts)  # no piece goes on over a blank
        self.fast = None
        if ranks:
            path, pattern = ranks
            with open(path, "rb") as lines:
                found = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            if any(self.a_bytes[rank] != token for token, rank in found.items()):
                raise ValueError(f"{path} has other tokens than {a_path}")
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})

    def plain(self, text: str) -> bool:
        return bool(_PLAIN.match(text))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by both; None where their bytes are not those of a blank and the text."""
        full = " " + text
        a = self.fast.encode_ordinary(full) if self.fast and self.plain(text) else self.a.encode(full, add_special_tokens=False).ids
        b, want = self.b.encode(text), full.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)


def pieces(text: str, size: int) -> Iterator[str]:
    """A long plain text in parts of about ``size`` characters, which both tokenizers treat by themselves: a
    part begins behind a blank that follows no white space and does not hold that blank. The first tokenizer cuts texts
    before such a blank, and no piece of the second one goes on over it."""
    at = 0
    while len(text) - at > size:
        cut = re.compile(r"(?<=\S) ").search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where to begin in both token lists so that parts of about ``size`` tokens are merged side by side:
    behind tokens that end together, found by bisection in a few tokens at each place."""
    out, at = [(0, 0)], size
    while at < len(ends_a):
        some = ends_a[at:at + 64]
        place = np.minimum(np.searchsorted(ends_b, some), len(ends_b) - 1)
        hit = np.flatnonzero(ends_b[place] == some)
        if len(hit) and at + hit[0] + 1 < len(ends_a):
            out.append((int(at + hit[0] + 1), int(place[hit[0]] + 1)))
        at += size
    return out


def merge(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the tokens that are linked, which also end a group, on both sides.

    ``starts`` has a row of both first tokens for every lane, ``stops_a`` its last token on the first side and one.
    """
    link_a, link_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    a, b = starts[:, 0].copy(), starts[:, 1].copy()
    stop = stops_a
    while len(a):
        x, y = ends_a[a], ends_b[b]
        same = x == y
        link_a[a[same]] = True
        link_b[b[same]] = True
        a += x <= y
        b += y <= x
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return link_a, link_b


@dataclass
class Found:
    """What is known of one document so far."""

    counts: list[int] = field(default_factory=lambda: [0, 0, 0])
    text: Callable = field(default_factory=sha256)
    pairs: list[np.ndarray] = field(default_factory=list)

    def add(self, n_a: int, n_b: int, pairs: np.ndarray, shown: bytes) -> None:
        self.text.update(b";" + shown if self.counts[0] else shown)
        self.counts = [self.counts[0] + n_a, self.counts[1] + n_b, self.counts[2] + len(pairs)]
        self.pairs.append(pairs)


def shown_ids(size: int) -> np.ndarray:
    """Each id with a comma, bar or semicolon behind it, three entries for an id."""
    return np.array([f"{k}{mark}" for k in range(size) for mark in ",|;"], "S")


def align(parts: list[tuple[np.ndarray, np.ndarray]], pair: Pair, shown: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Of every part, the linked id pairs in order, and its groups as text."""
    ids_a, ids_b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    at_a, at_b = (np.cumsum([0, *(len(p[k]) for p in parts)]) for k in (0, 1))
    ends_a, ends_b = np.empty(len(ids_a), np.int32), np.empty(len(ids_b), np.int32)
    starts, stops = [], []
    for k in range(len(parts)):
        a0, a1, b0, b1 = at_a[k], at_a[k + 1], at_b[k], at_b[k + 1]
        np.cumsum(pair.a_size[ids_a[a0:a1]], out=ends_a[a0:a1])
        np.cumsum(pair.b_size[ids_b[b0:b1]], out=ends_b[b0:b1])
        begin = lanes(ends_a[a0:a1], ends_b[b0:b1], size)
        starts += [(a0 + i, b0 + j) for i, j in begin]
        stops += [*(a0 + i for i, _ in begin[1:]), a1]
    link_a, link_b = merge(ends_a, ends_b, np.array(starts), np.array(stops))
    last_a, last_b = np.flatnonzero(link_a), np.flatnonzero(link_b)
    pairs = ids_a[last_a].astype(np.int64) << 32 | ids_b[last_b]
    # each token's place among all: the groups' first tokens come before their second ones
    group_a = np.cumsum(link_a) - link_a
    group_b = np.cumsum(link_b) - link_b
    codes = np.empty(len(ids_a) + len(ids_b), np.int32)
    before = np.concatenate([[0], last_b + 1])
    codes[np.arange(len(ids_a)) + before[group_a]] = ids_a * 3 + link_a
    codes[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = ids_b * 3 + 2 * link_b
    of = np.searchsorted(last_a, at_a)
    for k in range(len(parts)):
        text = shown[codes[at_a[k] + at_b[k]:at_a[k + 1] + at_b[k + 1]]].tobytes().translate(None, b"\0")
        yield pairs[of[k]:of[k + 1]], text[:-1]


def aligned(docs: DataFrame, a_path: str, b_path: str, rule: Align, ranks: tuple[str, str] | None) -> DataFrame:
    """The columns of :data:`SCHEMA`: one row for each row of ``id``, ``text``, with a number of its own."""

    def batched(rows: Iterator[tuple[int | None, str]]) -> Iterator[list]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1])
            if size >= rule.batch_bytes or len(held) >= 4096:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(a_path, b_path, ranks)
        shown = shown_ids(max(len(pair.a_bytes), len(pair.b_bytes)))
        number = TaskContext.get().partitionId() << 33
        rows = ((i, t or "") for batch in batches for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()))
        for held in batched(rows):
            found = [Found() for _ in held]
            # a part at a time of a text that fills a batch by itself
            one = len(held) == 1 and len(held[0][1]) > rule.batch_bytes and pair.apart and pair.plain(held[0][1])
            todo = [[(0, p)] for p in pieces(held[0][1], rule.batch_bytes)] if one else [[(k, t) for k, (_, t) in enumerate(held) if t]]
            for some in todo:
                coded = [(k, c) for k, t in some if (c := pair.encode(t)) is not None]
                if one and not coded:  # other bytes in a part are other bytes in the text
                    found = [Found()]
                    break
                for (k, (a, b)), (pairs, text) in zip(coded, align([c for _, c in coded], pair, shown, rule.lane) if coded else ()):
                    found[k].add(len(a), len(b), pairs, text)
            unique = [np.unique(np.concatenate(f.pairs), return_counts=True) if f.pairs else (np.zeros(0, np.int64),) * 2 for f in found]
            cut = pa.array(np.cumsum([0, *(len(p) for p, _ in unique)]), pa.int32())
            columns = [pa.array(np.arange(number, number + len(held))), pa.array([i for i, _ in held], pa.int64())]
            columns += [pa.array([f.counts[k] for f in found], pa.int64()) for k in (0, 1, 2, 2)]
            columns += [pa.array([f.text.hexdigest() if f.pairs else "" for f in found])]
            columns += [pa.ListArray.from_arrays(cut, pa.array(np.concatenate([u[k] for u in unique]))) for k in (0, 1)]
            number += len(held)
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return mapped(docs, run, SCHEMA)


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``count`` and ``best``, whether the second id has no link that is more frequent."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(second.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", second).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def with_counts(links: DataFrame, known: DataFrame, few: int) -> DataFrame:
    """``links`` with ``count`` and ``best``. The most frequent pairs, at most ``few`` of them, are
    broadcast, so that their links stay where they are; links of the other pairs are shuffled."""
    bits = F.floor(F.log2("count")).cast("int")
    sizes = sorted(((r.bits, r["count"]) for r in known.groupBy(bits.alias("bits")).count().collect()), reverse=True)
    least, total = 63, 0
    for bit, n in sizes:
        if total + n > few:
            break
        least, total = bit, total + n
    if total == sum(n for _, n in sizes):
        return links.join(F.broadcast(known), "pair")
    common, rare = known.filter(bits >= least), known.filter(bits < least)
    left = links.join(F.broadcast(common.select("pair")), "pair", "left_anti")
    return links.join(F.broadcast(common), "pair").unionByName(left.join(rare, "pair"))


def token_links(docs: DataFrame, a_path: str, b_path: str, rule: Align = Align(), ranks: tuple[str, str] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``: one row for each row of ``docs``.

    A blank and the text are tokenized by ``a_path`` (byte-level, tokenizers library), the text by
    ``b_path`` (sentencepiece, which adds the blank). A text that is null or empty, or whose tokens do not spell those bytes on either
    side, has no tokens: zeros and an empty digest. Groups are ``a1,a2|b1`` in the order of the text, joined by semicolons.
    A link's count is the number of links of its two ids in all rows; ``n_best`` counts the links that no other link of the second
    id beats. Repeated rows, and rows that share an id or have none, are documents of their own. Other columns play no part; an
    empty table gives an empty result.
    """
    docs = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    rows = stored(aligned(docs, a_path, b_path, rule, ranks), "aligned")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    known = stored(pair_counts(links), "pair-counts")
    sums = with_counts(links, known, rule.few).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    whole = rows.drop("pairs", "times").join(sums, "row", "left")
    none = F.lit(0).cast("long")
    return whole.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
                        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
