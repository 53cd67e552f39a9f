"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read as a flat run of blocks, cut at every tag that is not inline. Each block is
described by its words and link density, those of the blocks before and after it, and by what it
lies in. A decision tree, grown here from a small labelled table of pages, keeps or drops it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_labels import PAGES
from .store import picked

# Element names of HTML by their role.
_RAW = frozenset("script style title iframe textarea".split())  # what they hold is no markup
_UNSEEN = _RAW | frozenset("template noscript svg object canvas select math".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
                    "sub sup time tt u var wbr acronym label".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CHROME = frozenset("nav footer aside header menu button dialog fieldset".split())
_BODY = frozenset("article main".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id names that mark parts around the text, and the text itself.
_HINTS = frozenset("ad ads advert advertisement sponsor sponsored promo banner sidebar side menu nav navbar navigation "
                   "breadcrumb breadcrumbs header masthead footer cookie cookies consent popup modal newsletter subscribe signup "
                   "share sharing related recommended comment comments reply replies respond disqus widget toolbar "
                   "pagination pager".split())
# Words that may as well be what a text is about: they mark a part only where nothing but place and shape stands beside them.
_TOPICS = frozenset("notice alert social login search legal copyright disclaimer tags meta".split())
_PLACES = frozenset("area article bar block bottom box buttons col container content danger entry form global group icons info "
                    "inner item items left line link links list main media outer page panel post right row section site success "
                    "text top warning wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>|</?[a-zA-Z][^<>]*+\Z|([^<]++)|<",
    re.S | re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"(?:(?:has|with|no)[-_])?[a-z]+")  # a part that a page has is not the part itself

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "chrome", "hinted", "body", "heading", "listed")


@dataclass
class Block:
    """A run of text between two block tags."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    chrome: bool = False
    hinted: bool = False
    body: bool = False
    heading: bool = False
    listed: bool = False
    labelled: bool = False  # used by the labelled table only
    form: int = 0  # number of the form it lies in

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def marks_a_part(names: str) -> bool:
    """Whether one of the class, id and role names (lower case) stands for a part around the text."""
    for name in names.split():
        parts = set(_PART.findall(name))
        if not parts.isdisjoint(_HINTS) or not parts.isdisjoint(_TOPICS) and parts <= _TOPICS | _PLACES:
            return True
    return False


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order. Tags left open end with an enclosing tag or the page; so do
    unseen elements, but for scripts and styles, which end with the page."""
    out: list[Block] = []
    open_tags: list[tuple[str, bool, int]] = []  # name, hinted, number of the form
    now, label = Block(), False
    unseen = -1  # place of the outermost open element that is not shown
    forms: list[bool] = []  # of each form, whether it holds parts of a page
    open_ended: set[str] = set()  # raw elements without an end from here on

    def close() -> None:
        nonlocal now
        if now.parts and not "".join(now.parts).isspace():
            out.append(now)
        now = Block()

    at_char = 0
    while token := _TOKEN.match(page, at_char):
        at_char = token.end()
        ending, name, rest, text = token.groups()
        if text is not None or token[0] == "<":
            if unseen >= 0:
                continue
            value = html.unescape(text or "<")
            if not now.parts:
                names = {n for n, _, _ in open_tags}
                own = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] in _BODY), 0)
                now.chrome = bool(names & _CHROME)
                now.form = next((f for n, _, f in open_tags[own:] if n == "form"), 0)
                now.hinted = any(h for _, h, _ in open_tags)
                now.body = bool(names & _BODY)
                now.heading = bool(names & _HEADS)
                now.listed = "li" in names
                now.labelled = label
            now.parts.append(value)
            if any(n == "a" for n, _, _ in open_tags):
                now.linked += len(value.split())
            continue
        if not name:
            continue
        name = name.lower()
        if ending:
            at = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name), None)
            if unseen < 0 or at is not None and at < unseen:
                if name not in _INLINE and name not in _UNSEEN:
                    close()
                    label = False
            if at is not None:
                del open_tags[at:]
            unseen = unseen if unseen < len(open_tags) else -1
            continue
        if name in _RAW and name not in open_ended:
            if end := _RAW_END[name].search(page, at_char):
                at_char = end.end()
                continue
            open_ended.add(name)
        if name in ("script", "style"):
            break
        if name in _UNSEEN:
            if not rest.endswith("/"):
                unseen = unseen if unseen >= 0 else len(open_tags)
                open_tags.append((name, False, 0))
            continue
        if unseen >= 0:
            if name not in _VOID and not rest.endswith("/"):
                open_tags.append((name, False, 0))
            continue
        if name not in _INLINE:
            close()
            label = False
            last = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] not in _INLINE), -1)
            if last >= 0 and open_tags[last][0] == "p":
                del open_tags[last:]  # a paragraph ends where the next block begins
        label = label or "data-main" in rest
        if forms and (name in _CHROME | _BODY or name == "h1"):
            for _, _, f in open_tags:
                if f:
                    forms[f - 1] = True
        if name not in _VOID and (name == "a" or name not in _INLINE) and not rest.endswith("/"):
            names = " ".join("".join(m) for m in _NAMED.findall(rest)).lower() if rest else ""
            if name == "form":
                forms.append(False)
            # the page as a whole is never a part around the text
            hinted = name not in ("html", "body", "article", "main") and marks_a_part(names)
            open_tags.append((name, hinted, len(forms) if name == "form" else 0))
    close()
    held = {b.form for b in out if not (b.chrome or b.hinted)}
    page_form = min(held) if len(held) == 1 else 0  # a form around all there is to read is no form
    for b in out:
        b.chrome = b.chrome or b.form > 0 and not (b.form == page_form and forms[b.form - 1])
    return out


def features(found: list[Block]) -> np.ndarray:
    own = np.zeros((len(found) + 2, 2))
    for k, b in enumerate(found, 1):
        words = len("".join(b.parts).split())
        own[k] = words, b.linked / max(1, words)
    flags = np.array([[b.chrome, b.hinted, b.body, b.heading, b.listed] for b in found], float).reshape(len(found), 5)
    return np.hstack([own[1:-1], own[:-2], own[2:], flags])


@dataclass
class Node:
    """A leaf has no feature; else rows at or below the cut go to the first branch."""

    keep: bool
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 4) -> Node:
    """A tree of best Gini splits; the first feature and the lowest cut win a tie."""
    leaf = Node(bool(y.mean() >= 0.5)) if len(y) else Node(False)
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return leaf
    best = (len(y) * 2 * y.mean() * (1 - y.mean()) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n = low.sum()
            if least <= n <= len(y) - least:
                p, q = y[low].mean(), y[~low].mean()
                score = 2 * (n * p * (1 - p) + (len(y) - n) * q * (1 - q))
                if score < best[0]:
                    best = (score, f, cut)
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] <= best[2]
    return Node(leaf.keep, best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def trained() -> Node:
    """The tree of the labelled pages."""
    pages = [blocks(page) for page in PAGES]
    return grow(np.vstack([features(p) for p in pages]), np.array([b.labelled for p in pages for b in p], float))


def keeps(tree: Node, row: np.ndarray) -> bool:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.cut else tree.high
    return tree.keep


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, features(found)) if keeps(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``: one row for each row of ``pages``.

    The text is that of the kept blocks in page order, joined by a blank; character references
    are decoded, runs of white space inside a block become one blank. A null or empty page, or
    one without a kept block, has an empty text. Unclosed and cut-off markup is read to its end.
    Ids and addresses pass through, nulls and repeated rows included; other columns are left
    out. An empty table gives an empty result.
    """
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = picked(pages, id=id_col, url=url_col, html=html_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
