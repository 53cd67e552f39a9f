import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from paylens.llm import words as w
from paylens.llm.components import components
from paylens.llm.near_dup import Rule, near_duplicates

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_set(text, size):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(found))
    return {tuple(found[k:k + size]) for k in range(len(found) - size + 1)} if found else set()


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain(rows, size, percent):
    sets = {i: plain_set(t, size) for i, t in rows}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, plain_components(sets, links)


@settings(max_examples=50, deadline=None)
@cases(st.text(alphabet=" \t\n\x0b aAbÄé.", max_size=30))
def test_words_are_those_of_the_pattern(text):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = w.word_hashes(np.frombuffer(text.encode(), np.uint8))
    assert len(hashes) == len(found)
    assert len(set(hashes.tolist())) == len(set(found))


def test_shingles_are_a_set_with_a_rule_for_few_words():
    assert len(w.shingle_set(b"a b a b a b", 2)) == 2
    assert len(w.shingle_set(b"one", 2)) == 1 and len(w.shingle_set(b" ", 2)) == 0
    assert w.shingle_set(b"One  two", 2).tolist() == w.shingle_set(b"one two", 2).tolist()
    assert w.shingle_set(b"ab c", 2).tolist() != w.shingle_set(b"a bc", 2).tolist()


def test_rolling_hashes_agree_with_equal_runs():
    a, b = (w.word_hashes(np.frombuffer(t, np.uint8)) for t in (b"x y one two three z", b"one two three"))
    assert w.rolling(a, 3)[2] == w.rolling(b, 3)[0]
    assert len(w.rolling(b, 4)) == 0


@pytest.mark.parametrize("size", [2, 5])
def test_same_as_comparing_all_pairs(spark, given, size):
    docs = given("documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets, truth = plain(rows, size, 80)
    got = {r.doc_id: r for r in near_duplicates(docs, Rule(words=size)).collect()}
    assert len(got) == len(rows)
    for i, _ in rows:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), truth[i], truth[i] == i)


def test_strays_around_a_large_group(spark):
    """A group of near copies with members that are linked to each other but not to the group's pivot."""
    random = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(240):
        words_ = list(base)
        for k in random.choice(60, random.integers(0, 16), replace=False):
            words_[k] = f"x{random.integers(0, 40)}"
        rows.append((i, " ".join(words_)))
    _, truth = plain(rows, 2, 80)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Rule(words=2, block=16)).collect()
    assert {r.doc_id: r.component_id for r in got} == truth
    assert len(set(truth.values())) > 5


def test_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0
    assert all(by[i].component_id == i and by[i].kept for i in by)
    assert by[8].n_shingles == 1 and by[5].n_shingles > 0
    lost = [r for r in rows if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in lost] == [(None, True)]
    assert near_duplicates(none).collect() == []


def test_one_id_with_two_texts(spark):
    rows = [(1, "a b c d e f g"), (1, "p q r s t u v"), (2, "a b c d e f g"), (3, "p q r s t u v")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Rule(words=2)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1)}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_graphs(spark, seed):
    random = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in random.integers(0, 60, (45, 2))] + [(100 + k, 101 + k) for k in range(30)]
    got = components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()
    truth = plain_components({n for e in edges for n in e}, edges)
    assert {r.a: r.b for r in got} == {n: c for n, c in truth.items() if n != c}


def test_half_of_the_texts_empty_and_one_id_on_a_tenth_of_the_rows(spark):
    text = "concat('alpha beta gamma ', id % 7, ' delta epsilon zeta ', id % 7, ' eta theta ', id % 7)"
    docs = spark.range(2_000).selectExpr("if(id % 10 = 1, 5L, id) as doc_id", f"case id % 4 when 0 then null when 2 then ' ' else {text} end as text")
    rows = near_duplicates(docs, Rule(words=2)).collect()
    assert len(rows) == 2_000 and sum(r.n_shingles == 0 for r in rows) == 1_000
    assert all(r.kept and r.component_id == r.doc_id for r in rows if not r.n_shingles)
    filled = docs.filter("trim(text) != ''").collect()
    smallest, want = {}, {}
    for r in filled:
        smallest[r.text] = min(r.doc_id, smallest.get(r.text, r.doc_id))
    for r in filled:
        want.setdefault(r.doc_id, set()).add(smallest[r.text])
    assert all(r.component_id in want[r.doc_id] for r in rows if r.n_shingles)
