import zlib

import numpy as np

from paylens.llm.language_id import Net, classify, fit, gradients, identify, in_a_language, labelled_rows, log_probabilities, forward, sample_windows, windows

SMALL = Net(window=16, filters=3, dim=2, epochs=1, batch=8)


def test_gradients_are_those_of_the_loss():
    random = np.random.default_rng(0)
    rows, truth = random.integers(0, 256, (6, 16)).astype(np.uint8), random.integers(0, 3, 6)
    weights = {k: v.astype(np.float64) for k, v in fit(rows, truth, 3, SMALL).items()}
    loss = lambda: -log_probabilities(weights, forward64(weights, rows))[np.arange(6), truth].mean()
    got = gradients(weights, rows, truth, SMALL)
    for name in ("out", "out_bias", "filter2", "filter3", "bias4"):
        at = tuple(random.integers(0, s) for s in weights[name].shape)
        weights[name][at] += 1e-6
        up = loss()
        weights[name][at] -= 2e-6
        down = loss()
        weights[name][at] += 1e-6
        assert abs((up - down) / 2e-6 - got[name][at]) < 1e-4


def forward64(weights, rows):
    """Filters by hand, one place at a time."""
    out = []
    for w in SMALL.widths:
        e = weights["embed"][rows]
        runs = np.stack([e[:, k:k + w].reshape(len(rows), -1) for k in range(SMALL.window - w + 1)], axis=1)
        out.append(np.maximum((runs @ weights[f"filter{w}"]).max(axis=1) + weights[f"bias{w}"], 0))
    return np.concatenate(out, axis=1)


def test_forward_is_the_convolution_of_each_window():
    random = np.random.default_rng(1)
    rows = random.integers(0, 256, (5, 16)).astype(np.uint8)
    weights = fit(rows, np.zeros(5, int), 2, SMALL)
    assert np.allclose(forward(weights, rows, SMALL), forward64(weights, rows), atol=1e-5)


def test_windows_cover_whole_texts():
    rows, owner = windows([b"abcde", b"", b"xyz"], 2)
    assert owner.tolist() == [0, 0, 0, 2, 2]
    assert rows.tobytes().replace(b"\0", b"") == b"abcdexyz"


def test_a_text_is_judged_by_all_its_windows():
    rows = np.array([list(b"a" * 16), list(b"b" * 16)] * 30, np.uint8)
    weights = fit(rows, np.array([0, 1] * 30), 2, Net(window=16, filters=3, dim=2, epochs=20, batch=8))
    likely = classify([b"a" * 16, b"a" * 16 + b"b" * 160], weights, SMALL)
    assert likely[0].argmax() == 0 and likely[1].argmax() == 1


def test_held_out_accuracy(given):
    docs = given("documents", "sf0.01")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_odd_rows(odd, none):
    rows = identify(odd, Net(epochs=1)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert {by[i].lang_pred for i in (2, 3, 4, 7)} == {"und"} and {by[i].score for i in (2, 3, 4, 7)} == {0.0}
    assert by[5].lang_pred != "und" and by[None].held_out is False
    assert identify(none).collect() == []
    kept = in_a_language(odd, Net(epochs=1))
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 5, 6, 6, 8]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (4, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in identify(docs).collect()} == {("und", 0.0)}
    assert in_a_language(docs).count() == 2


def test_the_sample_is_bounded_where_ids_repeat_and_languages_are_many(spark):
    """20 ids of 1,500 rows each, and 500 languages of 10 rows each."""
    hot = spark.range(30_000).selectExpr("id % 20 as doc_id", "concat('text number ', id) as text", "'aa' as lang")
    many = spark.range(5_000).selectExpr("1000 + id as doc_id", "concat('other text ', id) as text", "concat('b', id % 500) as lang")
    rows = labelled_rows(hot.unionByName(many))
    found = [lang for lang, _ in sample_windows(rows, Net(per_language=100))]
    assert found.count("aa") == 100 and len(set(found)) == 501 and max(map(found.count, set(found))) <= 100
    few = sample_windows(rows, Net(per_language=100, languages=50, most=200))
    assert len({lang for lang, _ in few}) == 50 and "aa" in {lang for lang, _ in few} and len(few) <= 200
