"""Risk classifier on Spark ML, its metrics as aggregates, and its explanations."""

from __future__ import annotations

import builtins
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import contracts as k
from ..session import work_dir
from . import boosting
from .attribution import attributions
from .running import running_sums
from .sampling import sample_n

LABEL = "is_high_risk"
ROW_KEY = "provider_risk_id"
NO_CATEGORY = "__null__"
ROWS_PER_TASK = 25_000  # a level of a tree is a job: below this a task's start costs as much as its work
EVEN_TASKS = 16  # beyond these, tasks and their rows both grow, with the root of all rows


# Data -------------------------------------------------------------------------------------
def training_frame(risk: DataFrame, first: int, second: int) -> DataFrame:
    """Features and label of the provider-years that are above or below their median."""
    rows = risk.filter(F.col("year").isin(first, second) & F.col("withhold_risk_band").isin("High", "Low"))
    label = F.when(F.col("withhold_risk_band") == "High", 1).otherwise(0)
    return rows.select(ROW_KEY, *k.FEATURES, label.alias(LABEL))


def temporal_split(frame: DataFrame, first: int, second: int) -> tuple[DataFrame, DataFrame]:
    """Train on one year, test on the other."""
    return frame.filter(F.col("year") == first), frame.filter(F.col("year") == second)


def cap_rows(train: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A seeded sample of ``n`` rows, for a trial fit; no registered query takes one."""
    return sample_n(train, n, [ROW_KEY], seed)


def label_rate(frame: DataFrame) -> DataFrame:
    return frame.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(LABEL).cast("double")).alias("high_risk_rate")
    )


# Model ------------------------------------------------------------------------------------
def _prepared(frame: DataFrame) -> DataFrame:
    """A missing category is a category of its own; numbers become doubles."""
    return frame.select(
        *(x for x in frame.columns if x not in k.FEATURES),
        *(F.coalesce(x, F.lit(NO_CATEGORY)).alias(x) for x in k.CATEGORICAL),
        *(F.col(x).cast("double").alias(x) for x in k.NUMERIC),
    )


def fit_encoder(train: DataFrame, max_categories: int = k.MAX_CATEGORIES) -> PipelineModel:
    """One column per category, at most ``max_categories`` for a feature: the most frequent
    ones and one shared column for the rest. A value not seen in training gives zeros."""
    index = [f"{x}_index" for x in k.CATEGORICAL]
    slots = [f"{x}_slot" for x in k.CATEGORICAL]
    indexer = StringIndexer(
        inputCols=list(k.CATEGORICAL), outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"
    ).fit(train)
    cases = []
    for i, slot, labels in zip(index, slots, indexer.labelsArray):
        known, kept = len(labels), builtins.min(len(labels), max_categories)
        # frequency rank; ranks past the kept ones share the last slot; unseen stays outside
        cases.append(f"case when {i} >= {known} then {kept}.0 else least({i}, {kept - 1}.0) end as {slot}")
    group = SQLTransformer(statement=f"select *, {', '.join(cases)} from __THIS__")
    grouped = group.transform(indexer.transform(train))
    onehot = OneHotEncoder(
        inputCols=slots, outputCols=[f"{x}_onehot" for x in k.CATEGORICAL], handleInvalid="keep", dropLast=True
    ).fit(grouped)
    filled = [f"{x}_filled" for x in k.NUMERIC]
    imputer = Imputer(strategy="median", inputCols=list(k.NUMERIC), outputCols=filled).fit(grouped)
    assembler = VectorAssembler(
        inputCols=[f"{x}_onehot" for x in k.CATEGORICAL] + filled, outputCol="features"
    )
    return PipelineModel([indexer, group, onehot, imputer, assembler])


def encode(frame: DataFrame, encoder: PipelineModel) -> DataFrame:
    return encoder.transform(_prepared(frame))


def fit_tasks(rows: int) -> int:
    """A task per ``ROWS_PER_TASK`` rows. Each sends the sums of all nodes, features and bins of every level, however few
    its rows are, so many tasks are made larger instead of more in proportion."""
    tasks = max(1, math.ceil(rows / ROWS_PER_TASK))
    return tasks if tasks <= EVEN_TASKS else math.ceil(math.sqrt(EVEN_TASKS * tasks))


def fit_classifier(train: DataFrame, params: Mapping | None = None) -> PipelineModel:
    """Boosted trees over all rows. The training set is read once for every tree level, so it is
    kept in memory and spread by its size (:func:`fit_tasks`), not by cores. It is shuffled
    for that: every task carries the plan of what it reads, up to the last shuffle."""
    ready = _prepared(train).persist()
    try:
        parts = fit_tasks(ready.count())
        encoder = fit_encoder(ready)
        data = encoder.transform(ready).select("features", LABEL).repartition(parts)
        settings = {**k.GBT_PARAMS, **(params or {})}
        model = GBTClassifier(labelCol=LABEL, featuresCol="features", maxMemoryInMB=512, **settings).fit(data)
    finally:
        ready.unpersist()
    return PipelineModel([*encoder.stages, model])


def score(model: Transformer, frame: DataFrame) -> DataFrame:
    scored = model.transform(_prepared(frame))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(
        ROW_KEY, LABEL, "score", F.col("prediction").cast("int").alias("prediction")
    )


def fit_boosted(train: DataFrame, params: boosting.Boost = boosting.Boost(), cuts: Mapping | None = None) -> boosting.Boosted:
    """Second-order boosted trees with the same parameters: rows and columns are drawn once for a tree, and
    a missing number goes where it gains more instead of being filled."""
    return boosting.fit(_prepared(train), LABEL, k.NUMERIC, k.CATEGORICAL, [ROW_KEY], params, cuts)


def score_boosted(model: boosting.Boosted, frame: DataFrame) -> DataFrame:
    scored = _prepared(frame).withColumn("score", boosting.probability(boosting.margin(model)))
    return scored.select(ROW_KEY, LABEL, "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


def explain(model: boosting.Boosted, frame: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """How much each encoded column adds to the margin of each row, of all rows or of a seeded sample of ``n``."""
    rows = frame if n is None else sample_n(frame, n, [ROW_KEY], seed)
    return attributions(model, _prepared(rows), [ROW_KEY])


# Metrics ----------------------------------------------------------------------------------
def roc_auc(scored: DataFrame, label: str = LABEL, value: str = "score", by: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (ties count half), per group of ``by``.

    Equal scores are combined first. The running count of positives is then built over ``cells``
    ranges of the scores, by default as many as shuffle partitions, so no task has to walk
    through all scores; where the ranges are cut does not change the result.
    """
    by = list(by)
    hits, misses = F.sum(F.col(label).cast("bigint")), F.sum(F.lit(1).cast("bigint") - F.col(label))
    points = scored.groupBy(*by, F.col(value).alias("_s")).agg(hits.alias("_p"), misses.alias("_n"))
    points = running_sums(points, [F.col("_s").desc()], {"_upto": "_p"}, by, cells)
    twice = (2 * F.col("_upto") - F.col("_p")).cast("decimal(19,0)") * F.col("_n").cast("decimal(19,0)")  # doubled, to stay in whole numbers
    possible = 2.0 * F.sum("_p").cast("double") * F.sum("_n").cast("double")
    return points.groupBy(*by).agg((F.sum(twice).cast("double") / F.nullif(possible, F.lit(0.0))).alias("roc_auc"))


def confusion(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def classification_report(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.
    One pass makes the four counts; everything else is arithmetic on that single row."""
    y, z = F.col(label), F.col(prediction)
    counts = scored.agg(
        F.count_if((y == 1) & (z == 1)).alias("tp"), F.count_if((y == 0) & (z == 0)).alias("tn"),
        F.count_if((y == 0) & (z == 1)).alias("fp"), F.count_if((y == 1) & (z == 0)).alias("fn"),
    )

    def ratio(top, base):
        base = base.cast("double")
        return F.when(base > 0, top.cast("double") / base).otherwise(0.0)

    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    measured = counts.select(
        "tp", "tn", "fp", "fn",
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"), (tn + fp).alias("n0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"), (tp + fn).alias("n1"),
        (tp + tn + fp + fn).alias("n"),
    )
    for i in ("0", "1"):
        p, r = F.col(f"p{i}"), F.col(f"r{i}")
        measured = measured.withColumn(f"f{i}", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))

    def row(name, p, r, f, n):
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), n.alias("support")
        )

    def macro(x):
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x):
        return ratio(F.col(f"{x}0") * F.col("n0") + F.col(f"{x}1") * F.col("n1"), F.col("n"))

    accuracy = ratio(tp + tn, F.col("n"))
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        row("accuracy", accuracy, accuracy, accuracy, F.col("n")),
        row("macro avg", macro("p"), macro("r"), macro("f"), F.col("n")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("n")),
    )
    return measured.select(F.inline(rows))


def metrics_row(scored: DataFrame, train: DataFrame, first: int, second: int) -> DataFrame:
    """The one-row summary that is stored next to a model."""
    auc = roc_auc(scored).select(F.round("roc_auc", 4)).scalar()
    rows = train.agg(F.count(F.lit(1))).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.round(F.avg(F.col(LABEL).cast("double")), 4).alias("test_high_risk_rate"),
    ).select(
        F.current_timestamp().alias("trained_at"),
        F.lit(first).alias("train_year"), F.lit(second).alias("test_year"),
        rows.alias("train_rows"), "test_rows", auc.alias("roc_auc"), "test_high_risk_rate",
    )


SLOT_ROWS = 4096  # rows among which a feature is shuffled


# Explanations -----------------------------------------------------------------------------
def feature_names(model: PipelineModel) -> list[str]:
    """Names of the encoded columns, in vector order."""
    indexer, _, onehot, imputer = model.stages[:4]
    names = []
    for x, labels, size in zip(k.CATEGORICAL, indexer.labelsArray, onehot.categorySizes):
        kept = list(labels[:size])
        if len(labels) > size:
            kept[-1] = "infrequent"
        names += [f"{x}_{label}" for label in kept]
    return names + list(k.NUMERIC)


def importances(model: PipelineModel, n: int | None = None) -> DataFrame:
    """The gain of every feature over all trees, the largest first, or of the first ``n``."""
    gains = model.stages[-1].featureImportances.toArray()  # one number per encoded column
    ranked = sorted(zip(feature_names(model), (float(g) for g in gains)), key=lambda x: (-x[1], x[0]))[:n]
    return SparkSession.active().createDataFrame(ranked, "feature string, gain double")


def permutation_importance(
    model: Transformer, frame: DataFrame, columns: Sequence[str] = k.FEATURES, n: int | None = None, seed: int = 42
) -> DataFrame:
    """Loss of AUC when one feature is shuffled, over all rows, or over a seeded sample of ``n``.

    Rows are dealt by a hash of their key into slots of about ``SLOT_ROWS``. A feature is replaced
    by its value in another row of the slot (places under two seeded orders), so no task holds more
    than a slot, and all shuffled copies are scored in one job.
    """
    rows = frame if n is None else sample_n(frame, n, [ROW_KEY], seed)
    slots = rows.agg(F.ceil(F.count(F.lit(1)) / F.lit(SLOT_ROWS))).scalar()
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64(ROW_KEY, F.lit(seed - 1)), F.greatest(slots, F.lit(1))))
    place = lambda i: F.row_number().over(Window.partitionBy("_slot").orderBy(F.xxhash64(ROW_KEY, F.lit(seed + i)), ROW_KEY))
    rows = rows.withColumn("_at", place(0))
    copies = [rows.withColumn("feature", F.lit("(none)"))]
    for i, col in enumerate(columns):
        values = rows.select("_slot", place(1 + i).alias("_at"), F.col(col).alias("_value"))
        copies.append(
            rows.join(values, ["_slot", "_at"]).withColumn(col, F.col("_value")).drop("_value").withColumn("feature", F.lit(col))
        )
    stacked = reduce(DataFrame.unionByName, copies).drop("_at", "_slot")
    scored = model.transform(_prepared(stacked)).withColumn("score", vector_to_array("probability")[1])
    path = work_dir(frame.sparkSession, "scores")  # scored once, read by every measure
    scored.select("feature", LABEL, "score").write.parquet(path)
    auc = roc_auc(frame.sparkSession.read.parquet(path), by=["feature"])
    whole = auc.filter("feature = '(none)'").select("roc_auc").scalar()
    return auc.filter("feature <> '(none)'").select(
        "feature", "roc_auc", (whole - F.col("roc_auc")).alias("auc_drop")
    )


# Storage ----------------------------------------------------------------------------------
def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
