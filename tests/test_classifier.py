import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paylens import contracts as k
from paylens.contract import registry
from paylens.operators import classifier as ml


def frame(spark, n=400, categories=3):
    """Label depends on the volume; one feature and some categories are missing."""
    rows = []
    rng = random.Random(1)
    for i in range(n):
        volume = rng.random()
        rows.append((f"id{i}", None if i % 11 == 0 else f"s{i % categories:03d}", "TX", 2023 + i % 2, rng.randint(5, 50),
                     volume, None if i % 9 == 0 else rng.random(), 0.2, int(volume + rng.random() * 0.2 > 0.6)))
    return spark.createDataFrame(
        rows, "provider_risk_id string, cms_specialty string, provider_state string, year int, service_line_count bigint, "
        "total_services double, avg_medicare_payment double, specialty_median_withhold double, is_high_risk int")


def auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)


@settings(max_examples=8, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12).map(lambda x: x / 12)), max_size=60))
def test_auc_equals_all_pairs(spark, pairs):
    df = spark.createDataFrame(pairs, "is_high_risk int, score double")
    for cells in (1, 5, 256):
        row = ml.roc_auc(df, cells=cells).first()
        got, want = row and row.roc_auc, auc(pairs)
        assert got == want or abs(got - want) < 1e-12


def test_auc_per_group(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)], "g string, is_high_risk int, score double")
    assert {r.g: r.roc_auc for r in ml.roc_auc(df, by=["g"]).collect()} == {"a": 1.0, "b": 0.0}


def test_report_and_confusion(spark):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    df = spark.createDataFrame(pairs, "is_high_risk int, prediction int")
    got = {r["class"]: r for r in ml.classification_report(df).collect()}
    assert abs(got["1"].precision - 6 / 9) < 1e-12 and got["1"].recall == 0.75 and got["1"].support == 8
    assert got["accuracy"].f1 == 0.75 and abs(got["macro avg"].recall - 0.75) < 1e-12
    assert {(r.actual, r.predicted): r.rows for r in ml.confusion(df).collect()} == {(1, 1): 6, (1, 0): 2, (0, 1): 3, (0, 0): 9}
    none = {r["class"]: r for r in ml.classification_report(df.filter("prediction = 0")).collect()}
    assert none["1"].precision == 0.0 and none["1"].f1 == 0.0


def vectors(df):
    return {r.provider_risk_id: r.features.toArray().tolist() for r in df.collect()}


def test_encoder_groups_rare_values_and_zeroes_unseen_ones(spark):
    train = frame(spark, 600, categories=60).filter("cms_specialty is not null")
    encoder = ml.fit_encoder(ml._prepared(train), max_categories=10)
    seen = vectors(ml.encode(train, encoder))
    assert {len(v) for v in seen.values()} == {10 + 1 + 5}
    assert all(sum(v[:10]) == 1 for v in seen.values())
    shared = [v for v in seen.values() if v[9] == 1]
    assert len(shared) > len(train.collect()) / 2  # 51 of 60 values share the last column
    unseen = train.limit(1).withColumn("cms_specialty", F.lit("new"))
    assert sum(next(iter(vectors(ml.encode(unseen, encoder)).values()))[:10]) == 0


def test_missing_category_and_number(spark):
    train = frame(spark, 100)
    encoder = ml.fit_encoder(ml._prepared(train))
    assert {len(v) for v in vectors(ml.encode(train, encoder)).values()} == {4 + 1 + 5}  # 3 values and "missing"


def test_train_score_explain_save(spark, folder):
    data = frame(spark)
    train, test = ml.temporal_split(data, 2023, 2024)
    model = ml.fit_classifier(ml.cap_rows(train, 150), {"maxIter": 5, "maxDepth": 3})
    scored = ml.score(model, test)
    assert ml.roc_auc(scored).first().roc_auc > 0.8
    top = ml.importances(model, 3).collect()
    assert top[0].feature == "total_services" and len(top) == 3
    drops = {r.feature: r.auc_drop for r in ml.permutation_importance(model, test, n=100).collect()}
    assert set(drops) == set(k.FEATURES) and max(drops, key=drops.get) == "total_services"
    ml.save(model, folder + "/model")
    again = ml.score(ml.load(folder + "/model"), test)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
    row = ml.metrics_row(scored, train, 2023, 2024).first()
    assert (row.train_rows, row.test_rows) == (200, 200) and 0.8 < row.roc_auc <= 1


def test_training_frame(spark):
    risk = frame(spark, 30).drop("is_high_risk").withColumn(
        "withhold_risk_band", F.element_at(F.array(F.lit("High"), F.lit("Low"), F.lit("At Median")), (F.col("service_line_count") % 3 + 1).cast("int")))
    out = ml.training_frame(risk, 2023, 2024)
    assert out.count() == risk.filter("withhold_risk_band <> 'At Median'").count()
    assert out.agg(F.sum("is_high_risk")).first()[0] == risk.filter("withhold_risk_band = 'High'").count()


def test_fit_spreads_its_rows_by_their_number(spark, monkeypatch):
    """400 rows in tasks of about 50, whatever the partitions of the input, in a plan that starts at a shuffle."""
    sizes, plans = [], []

    class Watched(ml.GBTClassifier):
        def fit(self, data):
            sizes.extend(r.n for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
            plans.append(data._jdf.queryExecution().optimizedPlan().toString())
            return super().fit(data)

    monkeypatch.setattr(ml, "GBTClassifier", Watched)
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 50)
    ml.fit_classifier(frame(spark).coalesce(2), {"maxIter": 1})
    assert len(sizes) == 8 and sum(sizes) == 400 and max(sizes) <= 60
    assert plans[0].startswith("Repartition 8, true")


def test_split_takes_every_training_row(spark, monkeypatch):
    rows = spark.range(300_007).select(F.concat(F.lit("id"), "id").alias("provider_risk_id"), F.lit(registry.Y0).alias("year"))
    whole = rows.unionByName(rows.limit(5).withColumn("year", F.lit(registry.Y1)))
    monkeypatch.setattr(registry.Data, "training", lambda self: whole)
    assert [x.count() for x in registry.Data(spark, "").split()] == [300_007, 5]
    assert "least(" not in registry.METRICS_SQL


def test_many_tasks_of_a_fit_grow_with_their_rows(spark, monkeypatch):
    parts = []

    class Watched(ml.GBTClassifier):
        def fit(self, data):
            parts.append(data.rdd.getNumPartitions())
            return super().fit(data)

    monkeypatch.setattr(ml, "GBTClassifier", Watched)
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 4)
    ml.fit_classifier(frame(spark), {"maxIter": 1})
    assert parts == [40]  # 100 tasks of 4 rows before
    assert [ml.fit_tasks(n) for n in (0, 4, 64, 68, 6_400)] == [1, 1, 16, 17, 160]
