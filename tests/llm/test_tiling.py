import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from paylens.llm.tiling import Items, Tiling, contaminated, leaks, without_leaks


def plain_tiles(doc, item, seed):
    """Greedy string tiling by its definition: look at every pair of places, again and again."""
    in_doc, in_item, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and not in_doc[d + k] and not in_item[i + k]:
                    k += 1
                if k > best[0]:
                    best = (k, d, i)
        length, d, i = best
        if length < seed:
            return sorted(tiles)
        tiles.append((d, i, length))
        for k in range(length):
            in_doc[d + k] = in_item[i + k] = True


def words(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.sampled_from("abcd"), max_size=25), st.lists(st.sampled_from("abcd"), min_size=3, max_size=14))
def test_tiles(doc, item):
    rule = Tiling(seed=3, coverage=0.0)
    found = leaks(" ".join(doc).encode(), Items([7], pa.array([" ".join(item)]), 3), rule)
    want = plain_tiles(doc, item, 3)
    if not want:
        assert not found or found[0][1] == 0
        return
    (name, covered, n, coverage, longest, shown), = found
    assert (name, covered, n) == (7, sum(t[2] for t in want), len(item))
    assert shown == ",".join(f"{d}:{i}:{k}" for d, i, k in want)


def test_reordered_passages(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    parts = item.split()
    turned = " ".join(parts[8:] + ["and", "then"] + parts[:8])
    docs = spark.createDataFrame([(1, turned.upper()), (2, " ".join(parts[:6])), (3, "nothing of the kind is in here")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (10, None), (11, "one two"), (12, "")], "item_id long, text string")
    rows = contaminated(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.covered, r.coverage, r.longest) for r in rows] == [(1, 9, 16, 1.0, 8)]
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [2, 3]


@pytest.mark.parametrize("block_bytes", [16 << 20, 2_000])
def test_same_as_trying_all_pairs(given, block_bytes):
    docs, bench = given("documents"), given("benchmark")
    items = [(r.item_id, words(r.text)) for r in bench.collect()]
    want = set()
    for r in docs.select("doc_id", "text").collect():
        doc = words(r.text)
        runs = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
        for name, item in items:
            shared = {k + j for k in range(len(item) - 4) if tuple(item[k:k + 5]) in runs for j in range(5)}
            if len(shared) >= 0.5 * len(item) and len(item) >= 5:
                tiles = plain_tiles(doc, item, 5)
                if sum(t[2] for t in tiles) >= 0.5 * len(item):
                    want.add((r.doc_id, name))
    rows = contaminated(docs, bench, Tiling(block_bytes=block_bytes)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)


def test_a_passage_many_times():
    text = " ".join(["alpha beta gamma delta epsilon zeta"] * 500)
    items = Items([1], pa.array(["alpha beta gamma delta epsilon zeta"]), 5)
    assert [r[:3] for r in leaks(text.encode(), items, Tiling())] == [(1, 6, 6)]
    assert leaks(b"", items, Tiling()) == []


def test_odd_rows(odd, none, given):
    bench = given("benchmark")
    assert contaminated(odd, bench).collect() == [] and contaminated(none, bench).collect() == []
    own = odd.selectExpr("doc_id as item_id", "text", "id")
    rows = contaminated(odd, own).collect()
    assert {(r.doc_id, r.item_id) for r in rows} >= {(1, 1), (None, 1), (1, None), (5, 5), (6, 6)}
    assert sum(r.doc_id == r.item_id == 6 for r in rows) == 4
    assert contaminated(odd, own.limit(0)).collect() == []
    assert without_leaks(odd, own.limit(0)).count() == odd.count()
    assert np.isclose(max(r.coverage for r in rows), 1.0)
