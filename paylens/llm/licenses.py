"""License scans by conditional compression.

The words around every legal word are searched for the templates: common words lead to stretches
that hold one, whatever lines and paragraphs they are set in. Each stretch is compressed alone and
with every template as a raw zstandard dictionary; the templates are ranked by how much smaller
that makes it. The winners are confirmed by the exact differences in wording.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_templates import TEMPLATES
from .store import picked

_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_PLACED = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
# Words that license notices are made of and other prose rarely has.
LEGAL = re.compile(
    r"\b(?:licen[sc]\w*|sublicens\w*|copyright\w*|copyleft|warrant\w*|redistribut\w*|permission|permitted|rights[\W_]+reserved|"
    r"public[\W_]+domain|liab\w*|merchantability|noninfringement|spdx\w*|gnu|apache|mozilla|creative[\W_]+commons|cc[\W_]+by|tort|"
    r"damages|disclaim\w*|free[\W_]+software|without[\W_]+restriction|hereby[\W_]+granted|in[\W_]+no[\W_]+event|trademark\w*)\b", re.I)

SCHEMA = "start long, end long, license string, rank int, reduction double, wording double, differences string"


@dataclass(frozen=True)
class Scan:
    """Compression level, least reduction of a winner, least share of equal words."""

    level: int = 9
    reduction: float = 0.25
    wording: float = 0.75


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def differences(have: list[str], want: list[str]) -> tuple[float, str]:
    """Share of equal words, and every change from the template's wording to the block's."""
    match = difflib.SequenceMatcher(None, want, have, autojunk=False)
    changes = [f"-[{' '.join(want[a:b])}] +[{' '.join(have[c:d])}]" for tag, a, b, c, d in match.get_opcodes() if tag != "equal"]
    return match.ratio(), "; ".join(changes)


def stretch(want: list[str], have: list[str]) -> tuple[float, int, int, int]:
    """The part of ``have`` that is most like ``want``: share of equal words, their number, start and end."""
    blocks = [m for m in difflib.SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks() if m.size]
    best = (0.0, 0, 0, 0)
    for i, first in enumerate(blocks):
        same = 0
        for last in blocks[i:]:
            same += last.size
            end = last.b + last.size
            best = max(best, (2 * same / (len(want) + end - first.b), same, first.b, end))
    return best


class Ranker:
    """Compressors of all templates; made once in a worker."""

    def __init__(self, scan: Scan):
        self.scan = scan
        self.plain = zstandard.ZstdCompressor(level=scan.level, write_content_size=False)
        self.given = [
            (name, words(text), zstandard.ZstdCompressor(
                level=scan.level, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(" ".join(words(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
            for name, text in TEMPLATES]
        self.known: dict[str, list[tuple]] = {}
        self.bags = [Counter(text) for _, text, _ in self.given]
        # one word of a short template, or two of a longer one: more than ``wording`` allows to differ cannot part them all
        self.seeds: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for t, (_, text, _) in enumerate(self.given):
            size = 1 if len(text) < 6 else 2
            for j in range(len(text) - size + 1):
                self.seeds[tuple(text[j:j + size])].append((t, j))
        self.most_extra = 2 / scan.wording - 2  # words that a stretch can have beyond the template's, as a share of these
        self.reach = int(max(len(text) for _, text, _ in self.given) * (1 + self.most_extra)) + 1

    def rank(self, block: str) -> list[tuple[str, int, float, float, str]]:
        """Confirmed templates of a block, the largest reduction first, then by name."""
        tokens = words(block)
        key = " ".join(tokens)
        if key in self.known:
            return self.known[key]
        data = key.encode()
        alone = len(self.plain.compress(data))
        sizes = sorted((len(c.compress(data)), name, text) for name, text, c in self.given)
        winners = [(1 - size / alone, name, text) for size, name, text in sizes if 1 - size / alone >= self.scan.reduction]
        out, place = [], 0
        for reduction, name, text in winners:
            wording, changes = differences(tokens, text)
            if wording >= self.scan.wording:
                place += 1
                out.append((name, place, round(reduction, 6), round(wording, 6), changes))
        if len(self.known) < 50_000 and len(key) < 1_000:  # the notices that a corpus repeats
            self.known[key] = out
        return out

    def near(self, tokens: list[str], lo: int, hi: int) -> list[tuple[int, float, int, int]]:
        """Stretches of ``tokens[lo:hi]`` that are worded like a template: equal words, their share, start, end."""
        starts: dict[int, set[int]] = defaultdict(set)
        for i in range(lo, hi):
            for size in (1, 2):
                for t, j in self.seeds.get(tuple(tokens[i:i + size]), ()) if i + size <= hi else ():
                    starts[t].add((i - j) // max(1, len(self.given[t][1]) // 8))
        hits = set()
        for t, begun in starts.items():
            want, bag = self.given[t][1], self.bags[t]
            step, extra = max(1, len(want) // 8), int(len(want) * self.most_extra) + 1
            least = len(want) * self.scan.wording / (2 - self.scan.wording)  # fewer equal words cannot reach the share
            for k in begun:
                at = max(lo, k * step - extra)
                have = tokens[at:max(at, min(hi, (k + 1) * step + len(want) + extra))]
                if sum(min(c, bag[w]) for w, c in Counter(have).items() if w in bag) < least:
                    continue
                share, same, a, b = stretch(want, have)
                if share >= self.scan.wording:
                    hits.add((same, share, at + a, at + b))
        return sorted(hits, key=lambda h: (-h[0], -h[1], h[2], h[3]))

    def scan_words(self, tokens: list[str], lo: int, hi: int) -> list[tuple[int, int]]:
        """Start and end of the stretches that confirm a template and do not overlap: most equal words
        first, then what they leave is scanned again."""
        chosen: list[tuple[int, int]] = []
        for _, _, a, b in self.near(tokens, lo, hi):
            at = bisect(chosen, (a, b))
            if (at and chosen[at - 1][1] > a) or (at < len(chosen) and chosen[at][0] < b):
                continue
            if self.rank(" ".join(tokens[a:b])):
                chosen.insert(at, (a, b))
        rests = zip([lo, *(b for _, b in chosen)], [*(a for a, _ in chosen), hi]) if chosen else ()
        return sorted([*chosen, *(found for a, b in rests if b - a > 1 for found in self.scan_words(tokens, a, b))])

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """Start and end of every stretch of ``text`` that confirms a template; marks beside it up to
        the end of its line count in."""
        placed = [(m.start(), m.end()) for m in _PLACED.finditer(text)]
        tokens = [text[a:b].lower() for a, b in placed]
        regions: list[list[int]] = []
        for m in LEGAL.finditer(text):
            at = bisect(placed, (m.start(), len(text)))
            lo, hi = max(0, at - 1 - self.reach), min(len(placed), at + self.reach)
            if regions and lo <= regions[-1][1]:
                regions[-1][1] = hi
            else:
                regions.append([lo, hi])
        for region in regions:
            for a, b in self.scan_words(tokens, *region):
                start, end = placed[a][0], placed[b - 1][1]
                left, right = text.rfind("\n", 0, start) + 1, text.find("\n", end)
                right = len(text) if right < 0 else right
                yield (start if _PLACED.search(text, left, start) else left), (end if _PLACED.search(text, end, right) else right)


def find_licenses(docs: DataFrame, scan: Scan = Scan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``start``, ``end`` (code points), ``license``, ``rank``, ``reduction``,
    ``wording``, ``differences``: one row for each stretch and template that it confirms.

    A stretch goes from the first to the last word that it shares with the template that has the
    most words there, over lines and paragraphs. Texts that confirm no template, and null and
    empty texts, give no row. Templates that tie in size are ranked by name; repeated rows give
    repeated results; a missing id stays null; other columns play no part; an empty table gives
    an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(scan)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.string()]
        names = ["doc_id", *(part.split()[0] for part in SCHEMA.split(", "))]
        for batch in batches:
            rows = []
            legal = pc.match_substring_regex(batch.column("text"), LEGAL.pattern, ignore_case=True)
            batch = batch.filter(pc.fill_null(legal, False))
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for start, end in ranker.find(text):
                    rows += [(i, start, end, *hit) for hit in ranker.rank(text[start:end])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names)

    rows = picked(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, " + SCHEMA)
