import zlib

import numpy as np
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paylens.llm import rans
from paylens.llm import token_files as files
from paylens.llm.queries import VOCABULARY, token_files
from paylens.llm.store import stored
from paylens.llm.token_files import read_tokens, write_tokens
from paylens.llm.tokens import Encoder

CODER = Encoder(VOCABULARY)
PLAIN = Tokenizer.from_file(VOCABULARY)


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@cases(st.one_of(st.text(max_size=40), st.text(alphabet="aBc'stLl \t\n\x0b\x1c\x85\xa0ÄßéÿÝ12.,!?-²ªµ×÷<|>éﬁİΣ", max_size=40)))
def test_same_ids_as_the_tokenizer(text):
    assert np.frombuffer(CODER.encode(text), CODER.dtype).tolist() == ids(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|startoftext|>b", "It's WE'LL don'T", "x" * 5000, "Œuvre", "don't'll 's"])
def test_special_cases(text):
    assert np.frombuffer(CODER.encode(text), CODER.dtype).tolist() == ids(text)


def test_the_short_way_is_in_use():
    assert CODER.short


@pytest.mark.parametrize("n, kinds", [(0, 1), (1, 1), (5, 3), (255, 9), (256, 1), (257, 2), (32_768, 7), (32_769, 300), (100_000, 40_000)])
def test_round_trip(n, kinds):
    random = np.random.default_rng(n)
    symbols = np.minimum(random.zipf(1.3, n) - 1, kinds - 1).astype(np.uint32)
    table = rans.Table.of(np.bincount(symbols, minlength=kinds))
    block = rans.encode(symbols, table)
    assert (rans.decode(block, table) == symbols).all()
    for at in {0, 5, len(block) // 2, len(block) - 1} if n else set():
        damaged = bytearray(block)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            rans.decode(bytes(damaged), table)


def test_blocks_side_by_side_are_the_blocks_one_by_one():
    random = np.random.default_rng(3)
    blocks = [random.integers(0, 50, n).astype(np.uint32) for n in (0, 10, 40_000, 700)]
    table = rans.Table.of(np.ones(50))
    assert rans.encode_all(blocks, table) == [rans.encode(b, table) for b in blocks]


def test_size_is_close_to_the_entropy():
    symbols = np.minimum(np.random.default_rng(1).zipf(1.5, 200_000) - 1, 999).astype(np.uint32)
    share = np.bincount(symbols) / len(symbols)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(symbols) / 8
    assert len(rans.encode(symbols, rans.Table.of(np.bincount(symbols)))) < 1.25 * entropy


def test_table_keeps_rare_symbols():
    table = rans.Table.of(np.array([10**9, 1, 0, 1]))
    assert table.freq.sum() == 1 << rans.BITS and table.freq[1] >= 1 and table.freq[2] == 0


def test_files(spark, given):
    docs = given("documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in token_files(spark, docs).collect()}
    start = 0
    for r in rows:
        want = np.array([*ids(r.text), 1], "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_odd_rows(spark, odd, none, folder):
    write_tokens(odd, f"{folder}/odd", VOCABULARY)
    rows = read_tokens(spark, f"{folder}/odd").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    by = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows}
    assert by[2] == by[3] == by[4] == [1]
    texts = {r.doc_id: r.text for r in odd.select("doc_id", "text").collect()}
    assert all(found == [*ids(texts[i]), 1] for i, found in by.items())
    write_tokens(none, f"{folder}/none", VOCABULARY)
    assert read_tokens(spark, f"{folder}/none").collect() == []


def test_a_task_holds_one_python_worker(spark, folder, monkeypatch):
    """Two steps in a row hold two workers, and executors have memory for one a task."""
    seen = []

    def noted(df, name):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(files, "stored", noted)
    write_tokens(spark.createDataFrame([(2, "b c"), (1, None), (None, "a")], "doc_id long, text string"), f"{folder}/t", VOCABULARY)
    assert [plan.count("MapInArrow") for plan in seen] == [1]
    got = {r.doc_id: (r.start, r.n_tokens) for r in read_tokens(spark, f"{folder}/t").collect()}
    assert got == {None: (0, len(ids("a")) + 1), 1: (len(ids("a")) + 1, 1), 2: (len(ids("a")) + 2, len(ids("b c")) + 1)}
