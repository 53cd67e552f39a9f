import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paylens.llm import alignment
from paylens.llm.alignment import Align, Pair, lanes, merge, token_links
from paylens.llm.queries import QUERIES

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PAIR = Pair(A, B, RANKS)
ONE, TWO = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
ONE.encode_special_tokens = True
FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def a_bytes(i, table={}):
    if not table:
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        table.update({chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)})
    return bytes(table[c] for c in ONE.id_to_token(i))


def b_bytes(i):
    p = TWO.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()


def groups(text):
    """Groups of ids by walking over the bytes of one text."""
    if not text:
        return []
    a, b = ONE.encode(" " + text, add_special_tokens=False).ids, TWO.encode(text)
    ba, bb = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
        return []
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    ea, eb = ends(ba), ends(bb)
    out, i, j = [], 0, 0
    for cut in sorted(set(ea) & set(eb)):
        p, q = ea.index(cut, i) + 1, eb.index(cut, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def plain(docs):
    found = [(i, groups(t)) for i, t in docs]
    counts = Counter((a[-1], b[-1]) for _, g in found for a, b in g)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for i, g in found:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        links = [counts[a[-1], b[-1]] for a, b in g]
        best = sum(n == most[b[-1]] for n, (_, b) in zip(links, g))
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), best, sum(links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


def test_whole_table_as_by_walking(spark, given):
    docs = [(r.doc_id, r.text) for r in given("documents").collect()]
    assert rows(QUERIES["op12_lockstep"](spark, "/root/testdata/sf0.001")) == plain(docs)


ODD = ["", "one", " two  words ", "\n\n a\n  b c \n", "tab\tand\r\nlines ", "<s> <|endoftext|> </s>", "▁ x", "日本 語　x", "é é ﬁ", "\x00 nul",
       "naïve Äpfel don't I'LL 123 4567", " nbsp   x", "a" * 300 + " " * 70 + "b", "<0x41> �", "\U0001f600 smile", "x\x85y \x1c z"]


def test_odd_texts(spark):
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "one"), (1, "one"), (1, "one"), (99, None)]
    make = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(token_links(make, A, B)) == plain(docs)
    assert rows(token_links(make, A, B, Align(batch_bytes=20, lane=3), RANKS)) == plain(docs)


def test_odd_rows(odd, none):
    assert rows(token_links(odd, A, B)) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert token_links(none, A, B).collect() == []


def test_a_very_long_text_in_parts(spark):
    docs = [(1, "Some words, and lines\nof text - 12 of them. " * 3000), (2, "und noch  ein Text " * 800 + "▁"), (3, "kurz")]
    got = rows(token_links(spark.createDataFrame(docs, "doc_id long, text string"), A, B, Align(batch_bytes=5000, lane=64)))
    assert got == plain(docs) and got[1][1:4] == (0, 0, 0)


def test_pairs_beyond_the_broadcast_are_joined(spark, given):
    docs = given("documents").limit(40)
    assert rows(token_links(docs, A, B, Align(few=50))) == rows(token_links(docs, A, B)) == rows(token_links(docs, A, B, Align(few=0)))


@settings(max_examples=300, deadline=None)
@cases(st.one_of(st.text(alphabet=st.sampled_from("aBé\n\t'.1<s>\r-ß§°²½ªµ×÷ "), max_size=40), st.text(max_size=20),
                 st.lists(st.sampled_from(["I'll", "don't", " 'S", "12x", "naïve", "\r\n", "   ", "<|endoftext|>", "ÀÖ", "--", "the"])).map("".join)))
def test_ranks_give_the_tokenizer_s_ids(text):
    if text:
        got = PAIR.encode(text)
        assert (got is None) == (groups(text) == [])
        if got is not None:
            assert got[0].tolist() == ONE.encode(" " + text, add_special_tokens=False).ids and got[1].tolist() == TWO.encode(text)


def test_ranks_of_another_vocabulary_are_refused():
    with pytest.raises(ValueError, match="other tokens"):
        Pair(A, B, (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


@settings(max_examples=100, deadline=None)
@cases(st.text(alphabet="ab \n\t.", max_size=60), st.integers(1, 9))
def test_parts_have_the_ids_of_the_whole_text(text, size):
    """Each part with its own blank in front."""
    parts = [PAIR.encode(p) for p in alignment.pieces(text, size)] if text else []
    if text and all(p is not None for p in parts):
        want = PAIR.encode(text)
        assert [x for p in parts for x in p[0].tolist()] == want[0].tolist() and [x for p in parts for x in p[1].tolist()] == want[1].tolist()


@settings(max_examples=100, deadline=None)
@cases(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.randoms()), min_size=1, max_size=6), st.integers(1, 8))
def test_merging_side_by_side(texts, size):
    a, b, starts, stops, want_a, want_b = [], [], [], [], [], []
    for widths, random in texts:
        cuts = np.cumsum(widths)
        other = sorted({*random.sample(range(1, int(cuts[-1]) + 1), random.randint(1, int(cuts[-1]))), int(cuts[-1])})
        begin = lanes(cuts, np.array(other), size)
        starts += [(len(a) + i, len(b) + j) for i, j in begin]
        stops += [*(len(a) + i for i, _ in begin[1:]), len(a) + len(cuts)]
        a += cuts.tolist()
        b += other
        want_a += np.isin(cuts, other).tolist()
        want_b += np.isin(other, cuts).tolist()
    got_a, got_b = merge(np.array(a), np.array(b), np.array(starts), np.array(stops))
    assert got_a.tolist() == want_a and got_b.tolist() == want_b


@pytest.mark.parametrize("size", [10, 1000])
def test_parts_join_to_the_text(size):
    text = "ab  cd \n e f" * 50
    assert " ".join(alignment.pieces(text, size)) == text
