from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from paylens.llm.lz_prints import as_text, edited, fingerprint, fingerprints, likeness, Parsed, phrase_hashes, phrases


def plain_phrases(text):
    known, out = set(), []
    at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        if end > len(text):
            break  # the rest was seen before
        known.add(text[at:end])
        out.append(text[at:end])
        at = end
    return out


@settings(max_examples=200, deadline=None)
@cases(st.text(alphabet="abé\U0001f600", max_size=60))
def test_phrases(text):
    ends = []
    phrases(text, set(), ends)
    assert [text[a:b] for a, b in zip([0, *ends], ends)] == plain_phrases(text)
    hashes = phrase_hashes(text, ends)
    assert len(set(hashes.tolist())) == len(hashes)  # phrases differ from each other


@settings(max_examples=100, deadline=None)
@cases(st.text(alphabet="abcd ", max_size=80), st.text(alphabet="abcd ", max_size=80))
def test_the_shared_half_is_parsed_as_in_the_whole(text, other):
    now = Parsed(1, text)
    changed, print_ = now.edited(other)
    assert changed == edited(text, other)
    assert (now.print == fingerprint(text)).all() and (print_ == fingerprint(changed)).all()


def test_edit():
    assert edited("abcde", "XYZ") == "abcXY" and edited("abcd", "X") == "abX" and edited("", "X") == "" and edited("a", "X") == "a"


def test_likeness_estimates_the_share_of_common_phrases():
    random = np.random.default_rng(0)
    words = ["".join(random.choice(list("abcdefgh"), 5)) for _ in range(400)]
    a, b = " ".join(words), " ".join(words[:200] + [w[::-1] for w in words[200:]])
    x, y = set(plain_phrases(a)), set(plain_phrases(b))
    assert abs(likeness(fingerprint(a), fingerprint(b)) - len(x & y) / len(x | y)) < 0.2
    assert likeness(fingerprint(a), fingerprint(a)) == 1.0


def plain(rows):
    """By the definition, over rows in descending order of id."""
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -2**63), r[1] or ""))
    out = []
    for k, (i, text) in enumerate(order):
        text = text or ""
        other = order[(k + 1) % len(order)][1] or ""
        new = edited(text, other)
        own = fingerprint(text)
        out.append((i, len(text), sha256(new.encode()).hexdigest(), as_text(own), as_text(fingerprint(new)),
                    likeness(own, fingerprint(new)), likeness(own, fingerprint(other))))
    return sorted(out, key=str)


def test_whole_table(given):
    docs = given("documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in fingerprints(docs).collect()), key=str) == plain(rows)


def test_odd_rows(odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in fingerprints(odd).collect()), key=str) == plain(rows)
    assert fingerprints(none).collect() == []


@pytest.mark.parametrize("ids", [[5], [2**62, 2**62 + 1, 2**62 + 2, -2**62], [1, 1, 1], [None]])
def test_few_rows(spark, ids):
    rows = [(i, f"text {k} of some words") for k, i in enumerate(ids)]
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
