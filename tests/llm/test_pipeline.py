import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from paylens.llm.language_id import held_out
from paylens.llm.queries import QUERIES, VOCABULARY
from paylens.llm.raking import Mix, targets
from paylens.llm.store import stored

from .test_near_dup import plain
from .test_tiling import plain_tiles, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage, and the last result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, SF), name)
    return [*out, docs]


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "tokens"]
    assert all(df.schema == steps[0].schema for df in steps[:-1])


def test_language_drops_texts_without_letters(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert after == {i: t for i, t in before.items() if t and any(c.isalpha() for c in t)}


def test_near_dedup_keeps_the_smallest_of_each_group(steps):
    before = rows(steps[1])
    _, component = plain(before.items(), 5, 80)
    assert rows(steps[2]) == {i: t for i, t in before.items() if component[i] == i}


def test_decontaminate_drops_what_covers_an_item(spark, steps):
    before = rows(steps[2])
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {}
    for i, text in before.items():
        doc = words(text)
        runs = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
        near = [x for x in items if any(tuple(x[k:k + 5]) in runs for k in range(len(x) - 4))]
        if not any(sum(t[2] for t in plain_tiles(doc, x, 5)) >= 0.5 * len(x) for x in near):
            want[i] = text
    assert rows(steps[3]) == want and len(want) < len(before)


def test_mix_is_a_sample(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert 0 < len(after) < len(before) and all(before[i] == t for i, t in after.items())


def test_tokens_are_those_of_the_tokenizer(steps):
    coder, start = Tokenizer.from_file(VOCABULARY), 0
    got = {r.doc_id: r for r in steps[5].collect()}
    for i, text in sorted(rows(steps[4]).items()):
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_run_is_all_stages(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[5].collect()))


def test_odd_rows_pass_through_all_stages(spark, odd, none):
    for docs in (odd, none):
        out = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, out, SF), name)
            assert out.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == out.count()


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_operators_run_by_their_queries(spark):
    sizes = {name: query(spark, SF).count() for name, query in QUERIES.items()}
    n, pages = spark.read.parquet(f"{SF}/documents.parquet").count(), spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(sizes[name] == n for name in sizes if name.split("_")[0] in ("op1", "op3", "op4", "op7", "op9", "op10", "op12"))
    assert sizes["op5_html_blocks"] == pages and sizes["op6_warc_derivatives"] == 2 * pages
    assert sizes["op11_url_trees"] == pages and 0 < sizes["op13_bag_search"] <= 20 * spark.read.parquet(f"{SF}/benchmark.parquet").count()


def test_mix_draws_languages_without_a_target(spark):
    """A null language and a fifth one keep their own share; the named ones share the rest by their targets."""
    langs = ["'en'", "'de'", "'fr'", "'es'", "'it'", "cast(null as string)"]
    docs = spark.range(6000).selectExpr("id as doc_id", "'a b c' as text", f"array({', '.join(langs)})[id % 6] as lang", "concat('s', id % 5) as source")
    goals = {r.lang: r.target for r in targets(docs.selectExpr("coalesce(lang, '(none)') as lang", "3 as tokens"), "lang", Mix()).collect()}
    assert goals == pytest.approx({"en": 1 / 3, "de": 2 / 15, "fr": 0.1, "es": 0.1, "it": 1 / 6, "(none)": 1 / 6})
    kept = {r.lang: r["count"] for r in corpus_pipeline.mix(spark, docs, SF).groupBy("lang").count().collect()}
    assert all(abs(kept[lang] - 400) < 80 for lang in ("it", None)) and abs(kept["en"] - 800) < 80


def test_language_fills_what_is_missing(spark):
    """Held-out documents without a language get the right one; given languages stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(~held_out(F.col("doc_id")) | (F.length("text") < 200), F.col("lang")))
    truth, before = ({r.doc_id: r.lang for r in df.collect()} for df in (docs, hidden))
    after = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, hidden, SF).collect()}
    missing = [i for i in after if before[i] is None]
    assert missing and sum(after[i] == truth[i] for i in missing) >= 0.8 * len(missing)
    assert all(after[i] == before[i] for i in after if before[i])
