"""Language of a text by a byte convolutional network, in numpy.

A text is lower-cased and cut into fixed-length windows of bytes. Bytes are embedded, filters of
several widths slide over them, each filter keeps its maximum over the window, and a softmax layer
turns the maxima into language probabilities. A text's language has the largest sum of
log-probabilities over all its windows, each weighted by its share of the bytes.

The network is fitted on a bounded sample of labelled windows (``Net.per_language`` for each
language, ``Net.most`` in all, picked by a hash of the row); every text is classified as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import mapped, picked
from .words import slices, utf8

UNKNOWN = "und"


@dataclass(frozen=True)
class Net:
    """Window length, filter widths, filters of each width, embedding size, how much to learn from, and how to fit."""

    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    dim: int = 8
    per_language: int = 800
    languages: int = 1000
    most: int = 100_000
    epochs: int = 6
    batch: int = 64
    rate: float = 0.015
    seed: int = 11


Weights = dict[str, np.ndarray]


def windows(texts: list[bytes | memoryview], size: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zero bytes, and the text that each belongs to."""
    rows, owner = [], []
    for i, text in enumerate(texts):
        count = -(-len(text) // size)
        padded = np.zeros(count * size, np.uint8)
        padded[:len(text)] = np.frombuffer(text, np.uint8)
        rows.append(padded.reshape(count, size))
        owner.append(np.full(count, i))
    if not rows:
        return np.zeros((0, size), np.uint8), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(owner)


def _stacked(embedded: np.ndarray, width: int) -> np.ndarray:
    """The embeddings of every run of ``width`` bytes, side by side."""
    n, size, dim = embedded.shape
    return np.concatenate([embedded[:, k:size - width + 1 + k] for k in range(width)], axis=2)


def forward(weights: Weights, bytes_: np.ndarray, net: Net) -> np.ndarray:
    """The pooled filter outputs of each window. Filters slide over the windows end to end, one
    product for all widths; places where a filter would reach into the next window are left out."""
    n, size = bytes_.shape
    most = max(net.widths)
    flat = np.concatenate([bytes_.ravel(), np.zeros(most - 1, np.uint8)])
    embedded = np.stack([np.take(row, flat) for row in np.ascontiguousarray(weights["embed"].T)])
    runs = np.concatenate([embedded[:, k:k + n * size] for k in range(most)])
    filters = np.zeros((len(net.widths) * net.filters, most * net.dim), np.float32)
    for k, w in enumerate(net.widths):
        filters[k * net.filters:(k + 1) * net.filters, :w * net.dim] = weights[f"filter{w}"].T
    out = (filters @ runs).reshape(-1, net.filters, n, size)
    return np.concatenate([
        np.maximum(out[k, :, :, :size - w + 1].max(axis=2).T + weights[f"bias{w}"], 0)
        for k, w in enumerate(net.widths)], axis=1)


def log_probabilities(weights: Weights, pooled: np.ndarray) -> np.ndarray:
    scores = pooled @ weights["out"] + weights["out_bias"]
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def gradients(weights: Weights, bytes_: np.ndarray, truth: np.ndarray, net: Net) -> Weights:
    """Of the mean cross-entropy; each filter passes its gradient to the place of its maximum."""
    n, rows = len(bytes_), np.arange(len(bytes_))
    embedded = weights["embed"][bytes_]
    stacked, places, pooled = {}, {}, []
    for w in net.widths:
        stacked[w] = _stacked(embedded, w)
        out = stacked[w] @ weights[f"filter{w}"]
        places[w] = out.argmax(axis=1)
        pooled.append(np.maximum(out.max(axis=1) + weights[f"bias{w}"], 0))
    pooled = np.concatenate(pooled, axis=1)
    off = np.exp(log_probabilities(weights, pooled))
    off[rows, truth] -= 1
    off /= n
    grad = {"out": pooled.T @ off, "out_bias": off.sum(axis=0), "embed": np.zeros_like(weights["embed"])}
    back = (off @ weights["out"].T) * (pooled > 0)
    for k, w in enumerate(net.widths):
        part = back[:, k * net.filters:(k + 1) * net.filters]
        at = stacked[w][rows[:, None], places[w]]
        grad[f"filter{w}"] = np.einsum("nfd,nf->df", at, part)
        grad[f"bias{w}"] = part.sum(axis=0)
        spread = part[:, :, None] * weights[f"filter{w}"].T[None]
        for j in range(w):
            hit = bytes_[rows[:, None], places[w] + j]
            np.add.at(grad["embed"], hit, spread[:, :, j * net.dim:(j + 1) * net.dim])
    grad["embed"][0] = 0  # padding stays zero
    return grad


def fit(bytes_: np.ndarray, truth: np.ndarray, classes: int, net: Net) -> Weights:
    """Adam over shuffled batches; each batch cuts some windows short, so that short texts count too."""
    random = np.random.default_rng(net.seed)
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    weights = {"embed": random.normal(0, 1, (256, net.dim)).astype(np.float32),
               "out": draw(len(net.widths) * net.filters, classes), "out_bias": np.zeros(classes, np.float32)}
    for w in net.widths:
        weights |= {f"filter{w}": draw(w * net.dim, net.filters), f"bias{w}": np.zeros(net.filters, np.float32)}
    weights["embed"][0] = 0
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(net.epochs):
        order = random.permutation(len(bytes_))
        for at in range(0, len(order), net.batch):
            chosen = order[at:at + net.batch]
            part = bytes_[chosen].copy()
            length = np.where(random.random(len(part)) < 0.4, random.integers(8, net.window, len(part)), net.window)
            part[np.arange(net.window) >= length[:, None]] = 0
            step += 1
            rate = net.rate * (1 - epoch / net.epochs)
            for name, g in gradients(weights, part, truth[chosen], net).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                weights[name] -= np.float32(rate / (1 - 0.9**step)) * first[name] / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return weights


def held_out(doc_id: Column) -> Column:
    """Documents that no model here learns from; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample_windows(docs: DataFrame, net: Net) -> list[tuple[str, bytes]]:
    """Labelled windows, one of a picked row: at most ``per_language`` of each language and ``most`` in all, of
    the ``languages`` with the most labelled rows. Rows are picked, not ids, and their windows
    are cut before they are ranked, so that repeated ids bring no more than that."""
    labelled = docs.filter("id is not null and text is not null and lang is not null and not held")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "lang").limit(net.languages).collect()
    if not sizes:
        return []
    per = max(1, min(net.per_language, net.most // len(sizes)))
    known = docs.sparkSession.createDataFrame([(r.lang, r["size"]) for r in sizes], "lang string, size long")
    rows = labelled.select("lang", "text", F.xxhash64("id", "text", F.lit(net.seed)).alias("draw")).join(F.broadcast(known), "lang")
    share = (F.col("draw") / F.lit(2.0**64) + 0.5) * F.col("size")
    lower = F.encode(F.lower("text"), "UTF-8")
    at = F.pmod(F.col("draw"), F.greatest(F.lit(1), F.octet_length(lower) - (net.window - 1)))
    part = F.substring(lower, at.cast("int") + 1, F.lit(net.window))
    some = rows.filter(share <= 2 * per + 10).select("lang", "draw", part.alias("part"))  # so that a window sees few rows
    first = Window.partitionBy("lang").orderBy("draw", "part")
    some = some.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per)
    return sorted((r.lang, bytes(r.part)) for r in some.select("lang", "part").collect())


def labelled_rows(docs: DataFrame) -> DataFrame:
    rows = picked(docs, id="doc_id", text="text", lang="lang").withColumn("id", F.col("id").cast("long"))
    return rows.withColumn("held", held_out(F.col("id")))


def train(docs: DataFrame, net: Net) -> tuple[list[str], Weights]:
    """Languages in order, and the fitted network; no labelled text gives no language."""
    sample = [(lang, part) for lang, part in sample_windows(docs, net) if part]
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return [], {}
    padded = np.frombuffer(b"".join(part.ljust(net.window, b"\0") for _, part in sample), np.uint8)
    truth = np.array([languages.index(lang) for lang, _ in sample])
    return languages, fit(padded.reshape(-1, net.window), truth, len(languages), net)


def classify(texts: list[bytes | memoryview], weights: Weights, net: Net, block: int = 32) -> np.ndarray:
    """Probabilities of each language for each text, from all its windows."""
    rows, owner = windows(texts, net.window)
    total = np.zeros((len(texts), len(weights["out_bias"])))
    mass = np.zeros(len(texts))
    for at in range(0, len(rows), block):
        part, whose = rows[at:at + block], owner[at:at + block]
        share = (part > 32).sum(axis=1).astype(float)  # blanks and padding say nothing
        np.add.at(total, whose, log_probabilities(weights, forward(weights, part, net)) * share[:, None])
        np.add.at(mass, whose, share)
    total /= np.maximum(mass, 1)[:, None]
    likely = np.exp(total - total.max(axis=1, keepdims=True))
    return likely / likely.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, languages: list[str], weights: Weights, net: Net, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__lang_pred`` and ``__score``; rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            text = batch.column(batch.schema.get_field_index(text_col))
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            if languages:
                likely = classify(list(utf8(pc.utf8_lower(text))), weights, net)
                names, scores = np.array(languages, object)[likely.argmax(axis=1)], likely.max(axis=1)
            names[~letters], scores[~letters] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, "__lang_pred", "__score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__score", T.DoubleType())])
    return mapped(docs, run, schema)


def identify(docs: DataFrame, net: Net = Net()) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: one row for each row of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; other columns play no part. Learns from rows
    with an id, a text and a language that are not held out, and predicts from the text alone.
    A null, empty or letterless text is ``und`` with score 0, as is every text where nothing
    could be learned. Equal texts get equal rows; a tie goes to the first language by name; a
    row without an id counts as not held out. An empty table gives an empty result.
    """
    rows = labelled_rows(docs)
    out = predict(rows.select("id", "held", "text"), *train(rows, net), net)
    return out.select(F.col("id").alias("doc_id"), F.col("held").alias("held_out"),
                      F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))


def in_a_language(docs: DataFrame, net: Net = Net()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: those that :func:`identify`
    calls ``und`` go, and a null ``lang`` becomes the predicted one. If no language could be
    learned, nothing is rejected."""
    languages, weights = train(labelled_rows(docs), net)
    if not languages:
        return docs
    known = predict(docs, languages, weights, net).filter(F.col("__lang_pred") != UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "__lang_pred")).drop("__lang_pred", "__score")
