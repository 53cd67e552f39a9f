import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from paylens.llm import raking
from paylens.llm.queries import QUERIES
from paylens.llm.raking import MARGINS, Mix, described, oracle, probabilities, raked, sampled


def test_same_as_sql(spark):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    got = QUERIES["op7_raking"](spark, "/root/testdata/sf0.01")
    want = con.sql(oracle())
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    rows = lambda found: sorted(tuple(r) for r in found)
    assert rows(got.select(order).collect()) == rows(con.sql(f"select {', '.join(order)} from want").fetchall())


def test_margins_meet_their_targets(spark):
    random = np.random.default_rng(0)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(random.integers(1, 500))) for i in range(6) for j in range(3) for k in range(4)]
    mix = Mix(shares={"lang": {"l0": 0.5, "l1": 0.3, "absent": 0.1}, "topic": {"t0": 0.4, "t1": 0.3, "t2": 0.2, "t3": 0.1}}, rate=0.02)
    rows = raked(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), mix).collect()
    sums = {m: {} for m in MARGINS}
    for r in rows:
        for m in MARGINS:
            sums[m][r[m]] = sums[m].get(r[m], 0) + r.weight
    assert np.isclose(sum(sums["lang"].values()), 1) and np.isclose(sums["topic"]["t0"], 0.4)
    assert np.isclose(sums["lang"]["l0"], 0.5 / 0.9, atol=1e-6)  # the absent value's share is spread
    tokens = {}
    for s, _, _, t in cells:
        tokens[s] = tokens.get(s, 0) + t
    flat = {s: t**0.5 for s, t in tokens.items()}
    assert all(np.isclose(sums["source"][s], flat[s] / sum(flat.values()), atol=1e-6) for s in tokens)


def test_draws_follow_the_probabilities(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "'a b c' as text", "'en' as lang", "concat('s', id % 2) as source")
    share = sampled(rows, Mix(rate=0.3)).filter("__mix_kept").count() / 20_000
    assert abs(share - 0.3) < 0.02


def test_odd_rows(odd, none):
    out = sampled(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and set(odd.columns) <= set(out.columns)
    for r in rows:
        assert (r.text or "").strip() or (r["__mix_probability"] == 1.0 and r["__mix_kept"])
    twice = [r["__mix_kept"] for r in rows if r.doc_id == 6]
    assert twice[0] == twice[1]
    assert {r["_source"] for r in rows} == {"x", None}  # a column of the input under that name is left alone
    assert sampled(none).collect() == []


def test_probabilities_cover_every_cell_with_tokens(odd):
    rows = probabilities(described(odd), Mix(rate=1.0)).collect()
    assert rows and all(0 <= r["__mix_chance"] <= 1 for r in rows)


@pytest.mark.parametrize("name", ["source", "lang"])
def test_one_value_only(spark, name):
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, "c", "en", "s")], "doc_id long, text string, lang string, source string")
    assert sampled(docs, Mix(shares={}, rate=1.0)).filter("__mix_kept").count() == 2


def skewed(spark):
    """20 sources, each 95% in one language, one of them with a third of the tokens."""
    langs, topics = ["en", "de", "fr", "es"], ["general", "legal", "technical", "contact", "noisy"]
    cells = [(f"s{i}", lang, topic, max(1, int((100_000 if i == 0 else 10_000) * (0.95 if i % 4 == j else 0.05 / 3) / (k + 1))))
             for i in range(20) for j, lang in enumerate(langs) for k, topic in enumerate(topics)]
    return spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")


def scarce(spark):
    """Plenty of each value, but one cell has less than its share."""
    cells = [(f"s{i}", lang, topic, 40 if (i, lang) == (0, "es") else 4000)
             for i in range(4) for lang in ("en", "de", "fr", "es") for topic in ("general", "legal", "technical", "contact", "noisy")]
    return spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")


def off(rows, goals, weight):
    """How far the shares of the worst margin are off."""
    whole = sum(weight(r) for r in rows)
    return max(abs(sum(weight(r) for r in rows if r[m] == v) / whole - g) for m in MARGINS for v, g in goals[m].items())


def test_correlated_margins_are_fitted_until_they_are_met(spark, caplog):
    """Under the defaults but for the rate, which leaves every cell enough tokens."""
    cells = skewed(spark)
    goals = {m: {r[m]: r.target for r in raking.targets(cells, m, Mix()).collect()} for m in MARGINS}
    assert off(raked(cells, Mix(rate=0.02)).collect(), goals, lambda r: r.weight) < 1e-8 and not caplog.records
    assert off(raked(cells, Mix(rate=0.02, rounds=6, bounded=False)).collect(), goals, lambda r: r.weight) > 1e-3
    assert "off by" in caplog.text


def test_languages_without_a_target_keep_their_share(spark):
    cells = [("s", "en", "general", 600), ("s", "fr", "general", 100), ("s", "(none)", "general", 200), ("s", "xx", "general", 100)]
    goals = {r.lang: r.target for r in raking.targets(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), "lang", Mix()).collect()}
    assert goals == pytest.approx({"en": 0.7 * 0.5 / 0.65, "fr": 0.7 * 0.15 / 0.65, "(none)": 0.2, "xx": 0.1})


def test_same_as_sql_with_missing_and_other_languages(spark):
    """Cells that are scarce, a null source and languages without a target."""
    langs = "array('en', 'en', 'en', 'de', 'de', 'fr', 'fr', 'es', 'xx', null)[cast(id * 7 % 10 as int)]"
    docs = spark.range(3000).selectExpr("id as doc_id", f"{langs} as lang", "if(id % 11 = 0, null, concat('s', id % 4)) as source",
                                        "concat('a b c', if(id % 13 = 0, ' license', ''), if(id % 7 = 0, ' x@y', ''), if(id % 5 = 0, ' !!', ''), if(id % 17 = 0, ' password', '')) as text")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = {r.doc_id: (round(r["__mix_probability"], 6), r["__mix_kept"]) for r in sampled(docs, Mix(rate=0.2)).collect()}
    want = {r[0]: (r[1], r[2]) for r in con.sql(f"select doc_id, probability, kept from ({oracle(Mix(rate=0.2))})").fetchall()}
    assert got == want


@pytest.mark.parametrize("bounded", [False, True])
def test_many_cells_are_fitted_like_few(spark, monkeypatch, bounded):
    cells, mix = (scarce if bounded else skewed)(spark), Mix(rounds=None if bounded else 3, close=1e-4, bounded=bounded, rate=0.13)
    here = {tuple(r[m] for m in MARGINS): r.weight for r in raked(cells, mix).collect()}
    monkeypatch.setattr(raking, "FEW", 0)
    there = {tuple(r[m] for m in MARGINS): r.weight for r in raked(cells, mix).collect()}
    assert here.keys() == there.keys() and all(np.isclose(here[k], there[k], rtol=1e-6) for k in here)


def test_the_targets_are_drawn_where_cells_are_scarce(spark):
    """The tokens that the probabilities draw meet the rate and every target."""
    cells, mix = scarce(spark), Mix(rate=0.13)
    goals = {m: {r[m]: r.target for r in raking.targets(cells, m, mix).collect()} for m in MARGINS}
    docs = cells.selectExpr("source as __mix_source", "lang as __mix_lang", "topic as __mix_topic", "tokens as __mix_tokens")
    tokens = {(r.source, r.lang, r.topic): r.tokens for r in cells.collect()}

    def drawn(mix):
        rows = probabilities(docs, mix).collect()
        assert all(0 <= r["__mix_chance"] <= 1 for r in rows)
        return [Row(source=k[0], lang=k[1], topic=k[2], n=r["__mix_chance"] * tokens[k]) for r in rows
                for k in [(r["__mix_source"], r["__mix_lang"], r["__mix_topic"])]]

    rows = drawn(mix)
    assert np.isclose(sum(r.n for r in rows), 0.13 * sum(tokens.values())) and off(rows, goals, lambda r: r.n) < 1e-6
    cut = drawn(Mix(rate=0.13, bounded=False))
    assert sum(r.n for r in cut) < 0.1299 * sum(tokens.values())


def test_what_a_scarce_value_cannot_give_comes_from_the_others(spark):
    langs = {"en": 9000, "de": 9000, "fr": 1000, "es": 1000}
    docs = spark.createDataFrame([("s", k, "general", n) for k, n in langs.items()], "__mix_source string, __mix_lang string, __mix_topic string, __mix_tokens long")
    drawn = {r["__mix_lang"]: r["__mix_chance"] * langs[r["__mix_lang"]] for r in probabilities(docs, Mix()).collect()}
    assert drawn == pytest.approx({"en": 6000 * 5 / 7, "de": 6000 * 2 / 7, "fr": 1000, "es": 1000})


def test_targets_that_cannot_be_met_together_drop_no_cell(spark, caplog):
    rows = raked(skewed(spark), Mix()).collect()
    assert "cannot be met together" in caplog.text
    assert np.isclose(sum(r.weight for r in rows), 1) and all(r.weight > 1e-3 * r.tokens / 300_000 for r in rows)
