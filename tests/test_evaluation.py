import math
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.evaluation import (
    align_labels,
    assign_aliases,
    best_checkpoint,
    best_trial,
    classification_metrics,
    early_stopping,
    latest_run,
    mean_loss,
    metric_rows,
    passes_threshold,
)
from sluiceway.operators.models import search_parameters, text_and_label
from sluiceway.plans.training import aliases, evaluate_version, promote, train_and_gate, version_of
from sluiceway.schemas import METRIC_NAMES, MODEL_METRICS


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "prediction int, label int")
    row = classification_metrics(df).first()
    assert row.accuracy == 0.5
    assert [row.precision, row.recall, row.f1] == pytest.approx([0.5] * 3, abs=1e-8)


def test_metrics_without_positives_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(0, 0)], "prediction int, label int")
    row = classification_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_alignment_by_key_and_metric_rows(spark):
    p = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "k int, prediction int")
    y = spark.createDataFrame([(1, 1), (2, 0)], "k int, label int")
    rows = metric_rows(classification_metrics(align_labels(p, y, "k")))
    assert {r.metric for r in rows.collect()} == {"accuracy", "f1", "precision", "recall"}


def test_mean_loss_weighs_batches_equally(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, 3.0), (1, 2, 8.0)], "epoch int, batch int, loss double")
    assert mean_loss(df, "epoch", "batch", "loss").first().loss == 5.0


@pytest.mark.parametrize(
    "values, limits, options, expected",
    [
        ({"f1": 0.9, "loss": 0.2, "accuracy": 0.88}, {"f1": 0.85}, {}, True),
        ({"f1": 0.9, "loss": 0.2, "accuracy": 0.88}, {"f1": 0.95}, {}, False),
        ({"loss": 0.1}, {"f1": 0.5}, {}, False),
        ({"f1": 0.9}, {}, {}, True),
        ({"f1": 0.9}, {"val_f1": 0.85}, {}, False),
        ({"f1": 0.9}, {"val_f1": 0.85}, {"strip_prefix": "val_"}, True),
        ({"loss": 0.2}, {"loss": 0.3}, {}, False),
        ({"loss": 0.2}, {"loss": 0.3}, {"lower_is_better": ("loss",)}, True),
    ],
)
def test_threshold_gate(spark, values, limits, options, expected):
    df = spark.createDataFrame([tuple(values.get(m) for m in METRIC_NAMES)], MODEL_METRICS)
    assert df.select(passes_threshold(df.columns, limits, **options).alias("p")).first().p is expected


def test_aliases_follow_the_order_of_promotion(spark):
    rows = [("m", v, f1) for v, f1 in enumerate([0.9, 0.8, 0.1, 0.95, None])] + [("one", 1, 0.9), ("none", 1, 0.2)]
    df = spark.createDataFrame(rows, "model string, version int, f1 double")
    got = {(r.model, r.version, r.alias) for r in assign_aliases(df, passes_threshold(df.columns, {"f1": 0.5})).collect()}
    assert got == {("m", 3, "champion"), ("m", 1, "challenger"), ("one", 1, "champion")}


def test_best_trial(spark):
    rows = [("s", 0, 0.4, 1e-5), ("s", 1, 0.9, 2e-5), ("s", 2, 0.9, 3e-5), ("s", 3, None, 4e-5), ("s", 9, 2.0, 5e-5)]
    df = spark.createDataFrame(rows, "study string, trial int, f1 double, lr double")
    high = best_trial(df, "study", "trial", "f1", ["lr"]).first()
    assert (high.trial, high.value, high.lr) == (9, 2.0, 5e-5)
    tied = best_trial(df.where("trial < 9"), "study", "trial", "f1", ["lr"]).first()
    assert (tied.trial, tied.value, tied.lr) == (1, 0.9, 2e-5)
    low = best_trial(df, "study", "trial", "f1", ["lr"], "minimize").first()
    assert (low.trial, low.value) == (3, 0.0)


def test_latest_run(spark):
    df = spark.createDataFrame([("e", 1, "a"), ("e", 3, "b"), ("e", 2, "c")], "experiment string, start int, run string")
    assert latest_run(df, "experiment", "start", "run").first().run == "b"


# ---- early stop ---------------------------------------------------------------------------------


def fold(losses, patience=3, delta=1e-4):
    best, counter = math.inf, 0
    for epoch, loss in enumerate(losses, 1):
        if loss is not None and loss < best - delta:
            best, counter = loss, 0
        else:
            counter += 1
        if counter >= patience:
            return epoch, best
    return None, best


def as_metrics(spark, runs):
    rows = [(run, e, None if v is None else float(v)) for run, losses in runs.items() for e, v in enumerate(losses, 1)]
    return spark.createDataFrame(rows, "run string, epoch int, loss double")


def test_early_stop_example(spark):
    row = early_stopping(as_metrics(spark, {"r": [3, 2, 2, 2, 2]})).first()
    assert (row.stop_epoch, row.best_loss) == (5, 2.0)


@pytest.mark.parametrize("fold_rows", [4, 7, 1000])
def test_early_stop_equals_the_fold_for_any_chunking(spark, fold_rows):
    draw = random.Random(4)
    runs = {f"r{i}": [round(draw.uniform(0, 1) / (1 + e * draw.choice([0, 1])), 3) for e in range(draw.randint(1, 60))] for i in range(30)}
    # slow improvement: no significant gain in single steps, but one over several
    runs["slow"] = [1 - 0.00006 * e for e in range(200)]
    runs["falling"] = [100.0 - e for e in range(300)]
    runs["odd"] = [None, math.nan, math.inf, 0.1]
    runs["late"] = [None, None, 0.5, 0.4, None, 0.4, 0.4]
    got = {r.run: (r.stop_epoch, r.best_loss) for r in early_stopping(as_metrics(spark, runs), fold_rows=fold_rows).collect()}
    assert got == {run: fold(losses) for run, losses in runs.items()}


def test_early_stop_numbers_epochs_with_gaps(spark):
    losses = [3, 2, 2, 2, 2, 1]
    rows = [("r", 10 * e, float(v)) for e, v in enumerate(losses, 1)]
    df = spark.createDataFrame(rows, "run string, epoch int, loss double")
    assert early_stopping(df, fold_rows=4).first().stop_epoch == 50


def test_best_checkpoint(spark):
    metrics = as_metrics(spark, {"r": [3, 2, 2, 2, 2, 1], "zero": [0.0, 0.7, None, 0.6]})
    got = {r.run: (r.epoch, r.loss) for r in best_checkpoint(metrics, early_stopping(metrics)).collect()}
    # epoch 6 never ran; a zero loss reads as not measured
    assert got == {"r": (2, 2.0), "zero": (4, 0.6)}


# ---- models -------------------------------------------------------------------------------------


@pytest.fixture
def texts(spark):
    rows = [(i, f"good fine nice word{i % 3}" if i % 2 else f"bad poor word{i % 3}", i % 2) for i in range(120)]
    return spark.createDataFrame(rows, "doc_id int, text string, label int")


def test_text_and_label_columns(spark):
    assert text_and_label(spark.createDataFrame([(1, "t", 2)], "a int, text string, z int")) == ("text", "z")
    assert text_and_label(spark.createDataFrame([("t", 2)], "body string, y int")) == ("body", "y")


def test_training_job_gates_and_evaluates(spark, texts, tmp_path):
    base = str(tmp_path)
    for name, part in (("train", "doc_id < 80"), ("val", "doc_id between 80 and 99"), ("test", "doc_id >= 100")):
        texts.where(part).write.parquet(f"{base}/features/split={name}")
    first = train_and_gate(spark, f"{base}/features", base, {"f1": 0.5}, dimensions=256).first()
    second = train_and_gate(spark, f"{base}/features", base, {"f1": 0.5}, dimensions=256).first()
    rejected = train_and_gate(spark, f"{base}/features", base, {"auc": 0.5}, dimensions=256).first()
    assert first.passed and second.passed and not rejected.passed
    assert {r.alias: r.version for r in aliases(spark, base).collect()} == {"champion": second.version, "challenger": first.version}
    rows = {r.metric: r.value for r in evaluate_version(base, "champion", texts.where("doc_id >= 100")).collect()}
    assert rows["accuracy"] == 1.0 and set(rows) == {"accuracy", "f1", "precision", "recall", "loss"}


def test_promotion_and_rollback(spark, tmp_path):
    base = str(tmp_path)
    runs = [("m", 1, True), ("m", 2, True), ("m", 3, False), ("other", 4, False)]
    spark.createDataFrame(runs, "model string, version bigint, passed boolean").write.parquet(f"{base}/runs")

    def held():
        return {r.alias: r.version for r in aliases(spark, base).where("model = 'm'").collect()}

    assert held() == {"champion": 2, "challenger": 1}
    promote(spark, base, 3, "m")
    assert held() == {"champion": 3, "challenger": 2}
    promote(spark, base, 1, "m")
    assert held() == {"champion": 1, "challenger": 3} and version_of(spark, base, "champion", "m") == 1
    with pytest.raises(ValueError, match="no version 9"):
        promote(spark, base, 9, "m")
    with pytest.raises(ValueError, match="no champion of other"):
        version_of(spark, base, "champion", "other")


def test_parameter_search(spark, texts):
    trials = search_parameters(texts.where("doc_id < 80"), texts.where("doc_id >= 80"), trials=2, dimensions=256)
    rows = trials.collect()
    assert [r.trial for r in rows] == [0, 1] and all(2 <= r.max_iter <= 8 for r in rows)
    again = search_parameters(texts.where("doc_id < 80"), texts.where("doc_id >= 80"), trials=2, dimensions=256).collect()
    assert [r.reg_param for r in rows] == [r.reg_param for r in again]
