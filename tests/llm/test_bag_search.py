import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from paylens.llm.bag_search import Search, Vocabulary, best, oracle, ranked, terms
from paylens.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=20):
    """Every document against every item: (item, rank, id, score)."""
    bags = [(i, plain_terms(t)) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in bags), sum(len(t) for _, t in bags)
    counted = [(i, len(t), Counter(t)) for i, t in bags if t]
    df = Counter(t for _, _, bag in counted for t in bag)
    out = []
    for item, text in items:
        found = []
        for i, n, bag in counted:
            m = 100 - 25 + (25 * n * n_docs) // length
            s = 0
            for t in plain_terms(text):
                if t in bag:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return out


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def test_same_as_every_document_against_every_item(spark, given):
    docs, items = given("documents"), given("benchmark")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and rows(QUERIES["op13_bag_search"](spark, "/root/testdata/sf0.001")) == sorted(want, key=str)


def test_same_as_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.sql(f"select item_id, rank, doc_id, score from ({oracle()})").fetchall()
    assert rows(QUERIES["op13_bag_search"](spark, "/root/testdata/sf0.01")) == sorted(want, key=str)


def test_items_in_blocks_and_ties_by_id(spark):
    docs = [(k, "Äpfel und Birnen" if k % 3 else f"Birnen, und {k % 5} Bananen") for k in range(200)] + [(None, "äpfel Äpfel"), (None, "Birnen!")]
    items = [(1, "Äpfel"), (2, "birnen birnen bananen"), (2, "birnen birnen bananen"), (3, "3 und 4"), (4, "nichts davon"), (None, "Bananen")]
    make = lambda found, name: spark.createDataFrame(found, f"{name} long, text string")
    want = sorted(plain(docs, items), key=str)
    assert rows(ranked(make(docs, "doc_id"), make(items, "item_id"))) == want
    assert rows(ranked(make(docs, "doc_id"), make(items, "item_id"), Search(block_bytes=20))) == want
    one = [i for item, rank, i, _ in sorted(want, key=lambda r: r[1]) if item == 1]
    assert one == [None, *[k for k in range(200) if k % 3][:19]]  # then one class of 133 rows


def test_a_class_may_hold_most_rows(spark):
    docs = spark.range(5_000).selectExpr("5000 - id as doc_id", "if(id % 50 = 0, concat('rare word ', id), 'hot hot copy') as text")
    items = spark.createDataFrame([(1, "hot"), (2, "rare copy")], "item_id long, text string")
    assert rows(ranked(docs, items)) == sorted(plain([(r.doc_id, r.text) for r in docs.collect()], [(1, "hot"), (2, "rare copy")]), key=str)


def test_odd_rows(spark, odd, none):
    items = odd.filter("text is not null").withColumn("item_id", odd.doc_id)
    want = plain([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ranked(odd, items)) == sorted(want, key=str)
    assert ranked(none, items).collect() == [] and ranked(odd, items.limit(0)).collect() == []
    assert ranked(odd, spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")).collect() == []


@pytest.mark.parametrize("text", ["", "a B ä 12", "x" * 3_000_000 + " y", ("word " * 400_000) + "ende", "\x00a\x7fb"])
def test_terms_of_long_texts(text):
    assert [t.decode() for part in terms(text.encode()) for t in part] == plain_terms(text)


def test_best():
    items, scores, first = (np.array(x) for x in ([0, 1, 0, 0, 1], [5, 7, 9, 9, 7], [1, 4, 8, 2, 3]))
    assert best(items, scores, first, 2).tolist() == [3, 2, 4, 1]
    assert Vocabulary([1], [b"a b a"]).times.tolist() == [2, 1]
