"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field tags every word of every line with a kind or none,
from the shapes of the word and its neighbours; its weights are fitted to a small labelled table
by gradient ascent on the exact likelihood (forward-backward sums). Lines are decoded by Viterbi,
all lines of a batch at once, longest first, one step for each word position. Its spans are added
where no base span lies.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pii_labels import labelled
from .store import picked

KINDS = ("email", "ip", "card", "phone", "secret")  # in the order in which spans of one start are listed
LABELS = 1 + 2 * len(KINDS)  # none, then first word and further words of each kind

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, place in KINDS, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long words cost no second look."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            last = domain.end()
            yield start, last
        else:
            last = at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by start and kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# -- words and their features

_CLASSES = " aA9.@+-()=:_/"  # blank, letter, capital, digit, and marks of their own; one more for the rest
_CLASS = np.full(0x3002, 1, np.uint8)  # beyond ASCII everything counts as a letter but blanks
_CLASS[33:127] = len(_CLASSES)
_CLASS[0:33] = 0
_CLASS[[0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = 0
for _k, _c in enumerate(_CLASSES):
    _CLASS[ord(_c)] = _k
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_TRIM_END = np.zeros(0x3002, bool)
_TRIM_END[[ord(c) for c in ".,;:!?\"'"]] = True
_TRIM_START = np.zeros(0x3002, bool)
_TRIM_START[[ord(c) for c in "\"'"]] = True
_TABLES = (256, 64, 8192, 8192, 8192)  # values of each feature; the first counts known shapes


@dataclass
class Words:
    """Words of a text, without the quotes and stops around them, and their features by column."""

    start: np.ndarray
    end: np.ndarray
    line: np.ndarray  # words of one number are one sequence
    features: np.ndarray
    shape: np.ndarray


def _shapes(classes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's classes with repeats left out."""
    changed = np.ones(len(classes), bool)
    changed[1:] = classes[1:] != classes[:-1]
    changed[start] = True
    place = np.cumsum(changed)
    base = np.uint64(0x9E3779B97F4A7C15)
    if not len(start):
        return np.zeros(0, np.uint64)
    values = np.where(changed, classes.astype(np.uint64) + np.uint64(1), np.uint64(0))
    first = place[start]
    longest = int((place[end - 1] - first).max()) + 1
    powers = np.ones(longest, np.uint64)
    powers[1:] = np.cumprod(np.full(longest - 1, base))
    owner = np.repeat(np.arange(len(start)), end - start)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(end - start) - (end - start), end - start) + np.repeat(start, end - start)
    terms = values[inside] * powers[place[inside] - first[owner]]
    return np.add.reduceat(terms, np.concatenate([[0], np.cumsum(end - start)[:-1]]))


def words(text: str) -> Words:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.minimum(code, 0x3001)
    classes = _CLASS[code]
    inside = np.zeros(len(code) + 2, np.int8)
    inside[1:-1] = classes > 0
    steps = np.diff(inside)
    start, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    for _ in range(3):
        end = end - ((end - start > 1) & _TRIM_END[code[end - 1]])
    for _ in range(2):
        start = start + ((end - start > 1) & _TRIM_START[code[start]])
    size = end - start

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(code) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return sums[end] - sums[start]

    digits, dots, capitals = counted(classes == 3), counted(classes == 4), counted(classes == 2)
    letters = counted(classes == 1)
    marked = [counted(classes == _CLASSES.index(c)) > 0 for c in "@+-(=:"]
    digit_step = np.searchsorted([1, 3, 5, 8, 12, 20], digits, "right")  # 0 .. 6
    size_step = np.searchsorted([3, 6, 10, 16, 20, 24], size, "right")  # 0 .. 6
    mask = np.minimum(digit_step, 7) + 8 * np.minimum(dots, 3) + 32 * (letters > 0) + 64 * (capitals > 0)
    for k, flag in enumerate(marked):
        mask = mask + (128 << k) * flag
    before, after = np.zeros_like(mask), np.zeros_like(mask)
    line = np.zeros(len(code) + 1, np.int64)
    np.cumsum(code == 10, out=line[1:])
    line = line[start]
    same = line[1:] == line[:-1]
    before[1:][same], after[:-1][same] = mask[:-1][same] + 1, mask[1:][same] + 1
    columns = np.stack([np.zeros_like(mask), digit_step + 8 * size_step, mask, np.minimum(before, 8191), np.minimum(after, 8191)])
    return Words(start, end, line, columns, _shapes(classes, start, end))


# -- the field


@dataclass
class Field:
    """Weights of each feature value for each label, of label pairs, and of first labels."""

    known: np.ndarray
    tables: list[np.ndarray]
    steps: np.ndarray
    first: np.ndarray

    def scores(self, found: Words) -> np.ndarray:
        at = np.searchsorted(self.known, found.shape)
        at = np.where(self.known[np.minimum(at, len(self.known) - 1)] == found.shape, at + 1, 0)
        out = self.tables[0][at]
        for table, column in zip(self.tables[1:], found.features[1:]):
            out += table[column]
        return out


def _by_length(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each sequence, the longest first."""
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(line)))
    order = np.argsort(-size, kind="stable")
    return first[order], size[order]


def surely_none(scores: np.ndarray, field: Field) -> np.ndarray:
    """Words that have no label in any best path, whatever their neighbours have: for them, no
    other label can win back by its two steps what it loses by its score."""
    to = (field.steps - field.steps[:, :1]).max(axis=0)
    to = np.maximum(to, field.first - field.first[0])
    onwards = np.maximum((field.steps - field.steps[:1]).max(axis=1), 0)  # 0: there may be no next word
    return (scores[:, :1] > scores[:, 1:] + (to + onwards)[1:]).all(axis=1)


def viterbi(scores: np.ndarray, line: np.ndarray, field: Field) -> np.ndarray:
    """The best label of each word; a tie goes to the lower label.

    Words that surely have no label cut a line into stretches, which are decoded one by one:
    the step from such a word leads in, and the step to one leads out.
    """
    labels = np.zeros(len(line), np.uint8)
    open_ = np.flatnonzero(~surely_none(scores, field))
    if not len(open_):
        return labels
    cut = np.concatenate([[True], (np.diff(open_) > 1) | (line[open_[1:]] != line[open_[:-1]])])
    first, size = _by_length(np.cumsum(cut))
    first = open_[first]
    begins = np.where(first > 0, line[first - 1] != line[first], True)
    after = first + size
    stops = np.where(after < len(line), line[np.minimum(after, len(line) - 1)] != line[first], True)
    back = np.zeros(scores.shape, np.uint8)
    alpha = scores[first] + np.where(begins[:, None], field.first, field.steps[0])
    ends = np.empty_like(alpha)
    steps = np.ascontiguousarray(field.steps.T)
    for t in range(1, size[0]):
        n = int(np.searchsorted(-size, -t, "left"))  # stretches longer than t
        ends[n:len(alpha)] = alpha[n:]
        alpha = alpha[:n]
        paths = alpha[:, None, :] + steps
        best = paths.argmax(axis=2)
        at = first[:n] + t
        back[at] = best
        alpha = np.take_along_axis(paths, best[:, :, None], axis=2)[:, :, 0] + scores[at]
    ends[:len(alpha)] = alpha
    ends += np.where(stops[:, None], np.float32(0), field.steps[:, 0])
    now = ends.argmax(axis=1).astype(np.uint8)
    for t in range(size[0] - 1, -1, -1):
        n = int(np.searchsorted(-size, -t, "left"))
        at = first[:n] + t
        labels[at] = now[:n]
        now[:n] = back[at, now[:n]]
    return labels


def train(copies: int = 12, rounds: int = 120, rate: float = 0.15, ridge: float = 1e-3) -> Field:
    """Weights of largest penalised likelihood on the labelled table, by Adam on all of it."""
    rows = labelled(copies)
    found = words("\n".join(text for text, _ in rows))
    truth = np.zeros(len(found.start), np.int64)
    offset = 0
    for text, spans in rows:
        for kind, a, b in spans:
            inside = np.flatnonzero((found.end > offset + a) & (found.start < offset + b))
            truth[inside] = 2 + 2 * KINDS.index(kind)
            truth[inside[:1]] -= 1
        offset += len(text) + 1
    known = np.unique(found.shape)
    if len(known) >= _TABLES[0]:
        raise ValueError("too many shapes in the labelled table")
    field = Field(known, [np.zeros((n, LABELS)) for n in _TABLES], np.zeros((LABELS, LABELS)), np.zeros(LABELS))
    columns = found.features.copy()
    columns[0] = np.searchsorted(known, found.shape) + 1
    first, size = _by_length(found.line)
    gold = np.eye(LABELS)[truth]
    inner = found.line[1:] == found.line[:-1]
    gold_steps = np.zeros((LABELS, LABELS))
    np.add.at(gold_steps, (truth[:-1][inner], truth[1:][inner]), 1)
    weights = [*field.tables, field.steps, field.first]
    slow, fast = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for k in range(1, rounds + 1):
        marginal, pairs = expected(field.scores(found), first, size, field)
        off = gold - marginal
        grads = []
        for table, column in zip(field.tables, columns):
            g = np.zeros_like(table)
            np.add.at(g, column, off)
            grads.append(g)
        grads += [gold_steps - pairs, off[first].sum(axis=0)]
        for w, g, s, f in zip(weights, grads, slow, fast):
            g = g / len(size) - ridge * w
            s += 0.1 * (g - s)
            f += 0.01 * (g * g - f)
            w += rate * (s / (1 - 0.9**k)) / (np.sqrt(f / (1 - 0.99**k)) + 1e-8)
    field.tables = [t.astype(np.float32) for t in field.tables]
    field.steps, field.first = field.steps.astype(np.float32), field.first.astype(np.float32)
    return field


def expected(scores: np.ndarray, first: np.ndarray, size: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word and expected label pairs, by scaled forward-backward sums."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, start = np.exp(field.steps), np.exp(field.first)
    alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.ones(len(e))
    alpha[first] = e[first] * start
    longer = lambda t: int(np.searchsorted(-size, -t, "left"))
    for t in range(size[0]):
        at = first[:longer(t)] + t
        if t:
            alpha[at] = (alpha[at - 1] @ step) * e[at]
        scale[at] = alpha[at].sum(axis=1)
        alpha[at] /= scale[at][:, None]
    pairs = np.zeros_like(step)
    for t in range(size[0] - 1, 0, -1):
        at = first[:longer(t)] + t
        right = e[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = right @ step.T
        pairs += step * (alpha[at - 1].T @ right)
    return alpha * beta, pairs


# -- spans


def tagged(text: str, field: Field) -> list[Span]:
    """Spans of neighbouring words that the field gives one kind, in order."""
    found = words(text)
    labels = viterbi(field.scores(found), found.line, field)
    out: list[Span] = []
    last = -2
    for k in np.flatnonzero(labels):
        kind, start, end = (int(labels[k]) - 1) // 2, int(found.start[k]), int(found.end[k])
        if labels[k] % 2 == 0 and last == k - 1 and out[-1][1] == kind and found.line[k] == found.line[last]:
            out[-1] = (out[-1][0], kind, end)
        else:
            out.append((start, kind, end))
        last = k
    return out


def added(text: str, span: Span) -> Span | None:
    """A tagged span without the name before a value, if it can be what it is said to be."""
    start, kind, end = span
    value = text[start:end]
    if kind == 4 and (cut := max(value.find("="), value.find(":"))) >= 0:
        start += cut + 1
        value = text[start:end].strip("\"'")
        start = end - len(value) if text[start:end].endswith(value) else start
    digits = sum("0" <= c <= "9" for c in value)
    if kind == 0 and "@" not in value or kind == 1 and digits < 4 or kind == 3 and not 7 <= digits <= 15:
        return None
    if kind == 2 and not (12 <= digits <= 19 and luhn("".join(c for c in value if "0" <= c <= "9"))):
        return None
    if kind == 4 and (digits < 2 or len(value) < 12):
        return None
    return start, kind, end


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text. Texts are tagged together, line ends between them."""
    whole = "\n".join(texts)
    tags = tagged(whole, field)
    out, at, offset = [], 0, 0
    for text in texts:
        base = base_spans(text)
        more = []
        while at < len(tags) and tags[at][0] < offset + len(text):
            span = added(text, (tags[at][0] - offset, tags[at][1], tags[at][2] - offset))
            if span and not any(a < span[2] and span[0] < b for a, _, b in base):
                more.append(span)
            at += 1
        out.append((base, sorted(base + more)))
        offset += len(text) + 1
    return out


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = 500_000) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``,
    ``n_added``: one row for each row of ``docs``.

    Counts and the digest are those of the base spans; ``spans`` has all of them, as
    kind:start:end in code points, the end exclusive. Null and empty texts have no spans and the
    digest of the empty string. Whole texts are read; ``chars`` only bounds how many short texts
    are tagged at a time. Repeated rows give repeated results, a missing id stays null, other
    columns play no part, an empty table gives an empty result.
    """
    field = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            results, at = [], 0
            while at < len(texts):
                upto, size = at + 1, len(texts[at])
                while upto < len(texts) and size + len(texts[upto]) <= chars:
                    size += len(texts[upto])
                    upto += 1
                results += scan(texts[at:upto], field)
                at = upto
            counts = np.array([[sum(k == kind for _, k, _ in base) for kind in range(4)] for base, _ in results], np.int64).reshape(-1, 4)
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in results]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c) for c in counts.T), pa.array(digests, pa.string()),
                 pa.array([joined(every) for _, every in results], pa.string()),
                 pa.array([len(every) - len(base) for base, every in results], pa.int64())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    rows = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
