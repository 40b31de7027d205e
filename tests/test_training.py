"""Epochs, the training job's ledger, least squares and answers, against plain numpy and against their own records."""

import dataclasses
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.operators import linear
from sluiceway.operators.evaluation import best_checkpoint, early_stopping
from sluiceway.operators.linear import EpochSettings, LinearTextModel, TextFeatures, best_epoch, epoch_metrics, feature_rows, fit_epochs, least_squares, numeric_rows
from sluiceway.operators.serving import answer_requests
from sluiceway.plans.training import aliases, promote, version_of
from sluiceway.plans.training_job import Ledger, run_training_job

SETTINGS = EpochSettings(epochs=8, learning_rate=0.8, warmup_ratio=0.25, weight_decay=0.02)


def texts(n, seed):
    rng = np.random.default_rng(seed)
    words = [["good", "fine", "calm"], ["bad", "loud", "odd"]]
    out = []
    for _ in range(n):
        label = int(rng.integers(2))
        out.append((" ".join(rng.choice([*words[label], *words[label if rng.random() < 0.7 else 1 - label], "the", "of."], int(rng.integers(1, 9)))), label))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    make = lambda n, seed: spark.createDataFrame([*texts(n, seed), (None, 1), ("", 0)], "text string, label int").repartition(5)
    return make(300, 1), make(120, 2)


@pytest.fixture(scope="module")
def rows(labelled):
    return [feature_rows(x, TextFeatures(words=32)) for x in labelled]


def plain_run(train, val, width, s):
    """The same epochs in dense numpy."""

    def dense(df):
        found = df.collect()
        x = np.zeros((len(found), width))
        for i, r in enumerate(found):
            x[i, r.places] = r["values"]
        return x, np.array([int(r.label) for r in found])

    (x, y), (xv, yv) = dense(train), dense(val)
    w, m, v, out = np.zeros((width, 2)), np.zeros((width, 2)), np.zeros((width, 2)), []

    def chances(a, w):
        e = np.exp(a @ w)
        return e / e.sum(axis=1, keepdims=True)

    for t in range(1, s.epochs + 1):
        p = chances(x, w)
        train_loss = -np.log(p[np.arange(len(y)), y]).mean()
        p[np.arange(len(y)), y] -= 1
        g = x.T @ p / len(y)
        m, v = s.beta1 * m + (1 - s.beta1) * g, s.beta2 * v + (1 - s.beta2) * g * g
        w = w * (1 - s.rate(t) * s.weight_decay) - s.rate(t) * (m / (1 - s.beta1**t)) / (np.sqrt(v / (1 - s.beta2**t)) + s.eps)
        p = chances(xv, w)
        out.append((t, train_loss, -np.log(p[np.arange(len(yv)), yv]).mean(), (p.argmax(axis=1) == yv).mean(), w))
    return out


def test_epochs_equal_a_plain_run(spark, rows, tmp_path):
    path = str(tmp_path / "run")
    weights = fit_epochs(*rows, TextFeatures(32).width, path, SETTINGS)
    expected = plain_run(*rows, TextFeatures(32).width, SETTINGS)
    got = epoch_metrics(spark, path).orderBy("epoch").collect()
    for r, (t, train_loss, val_loss, accuracy, _) in zip(got, expected):
        assert (r.epoch, r.train_loss, r.val_loss, r.val_accuracy) == (t, pytest.approx(train_loss), pytest.approx(val_loss), pytest.approx(accuracy))
    assert weights == pytest.approx(expected[best_epoch(spark, path) - 1][4], abs=1e-9)


@pytest.mark.parametrize("rate, patience", [(0.8, 3), (6.0, 2), (40.0, 1)])
def test_stop_and_kept_epoch_equal_the_operators_over_the_runs_metrics(spark, rows, tmp_path, rate, patience):
    path = str(tmp_path / "run")
    s = dataclasses.replace(SETTINGS, learning_rate=rate, patience=patience, epochs=7, warmup_ratio=0.0)
    fit_epochs(*rows, TextFeatures(32).width, path, s)
    metrics = epoch_metrics(spark, path).withColumn("run", F.lit("r"))
    stops = early_stopping(metrics, loss="val_loss", patience=patience)
    last = metrics.agg(F.max("epoch")).first()[0]
    stop = stops.first().stop_epoch
    assert last == (stop if stop is not None else 7)
    assert best_checkpoint(metrics, stops, loss="val_loss").first().epoch == best_epoch(spark, path)


def test_a_broken_run_goes_on_and_ends_alike(spark, rows, tmp_path, monkeypatch):
    width, whole, broken = TextFeatures(32).width, str(tmp_path / "whole"), str(tmp_path / "broken")
    expected = fit_epochs(*rows, width, whole, SETTINGS)
    ran = epoch_metrics(spark, whole).count()
    passes, real = [], linear.epoch_pass

    def failing(*args, **options):
        passes.append(1)
        if len(passes) == 6:  # in the middle of the third epoch
            raise RuntimeError("executor lost")
        return real(*args, **options)

    monkeypatch.setattr(linear, "epoch_pass", failing)
    with pytest.raises(RuntimeError):
        fit_epochs(*rows, width, broken, SETTINGS)
    assert epoch_metrics(spark, broken).count() == 2
    assert fit_epochs(*rows, width, broken, SETTINGS) == pytest.approx(expected, abs=1e-12)
    assert len(passes) == 6 + 2 * (ran - 2)  # no epoch is done twice
    assert fit_epochs(*rows, width, broken, SETTINGS) == pytest.approx(expected, abs=1e-12) and len(passes) == 6 + 2 * (ran - 2)


def test_nothing_to_train_on(spark, rows, tmp_path):
    empty = rows[0].limit(0)
    weights = fit_epochs(empty, empty, 36, str(tmp_path / "none"), dataclasses.replace(SETTINGS, epochs=2))
    assert weights.shape == (36, 2) and not weights.any()


def test_sums_of_many_tasks_are_added_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(linear, "FAN", 3)
    monkeypatch.setattr(linear, "SLAB", 4)
    df = spark.range(0, 1000, 1, 29).select(F.col("id").cast("double").alias("label"))
    total = linear.added_up(df, lambda b: np.array([b["label"].to_numpy().sum() * k for k in range(11)]), 11)
    assert total.tolist() == [499500.0 * k for k in range(11)]


def test_text_features():
    places, values, first = TextFeatures(8)(pa.array(["A a b.", None, ""]))
    assert first.tolist() == [0, 6, 10, 14] and places[:4].tolist() == [0, 1, 2, 3]
    assert values[:4].tolist() == pytest.approx([1, math.log(7) / 10, 2 / 6, 1 / 6])
    assert (values[4:6] ** 2).sum() == pytest.approx(1) and values[6:10].tolist() == [1, 0, 0, 0]
    assert [len(x) for x in TextFeatures(8)(pa.array([], pa.string()))] == [0, 0, 1]


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) * [1, 1e4, 1e-3]
    y = 2 + x @ [3, 0.5, 900] + rng.normal(size=500)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double").repartition(7)
    got = least_squares(numeric_rows(df, ["a", "b", "c"], "y"), 4)
    assert got == pytest.approx(np.linalg.lstsq(np.column_stack([np.ones(500), x]), y, rcond=None)[0], rel=1e-8)
    twice = df.withColumn("d", F.col("a") * 2)
    rows = numeric_rows(twice, ["a", "d"], "y")
    guess = least_squares(rows, 3)
    assert np.column_stack([np.ones(500), x[:, 0], 2 * x[:, 0]]) @ guess == pytest.approx(
        np.column_stack([np.ones(500), x[:, 0]]) @ np.linalg.lstsq(np.column_stack([np.ones(500), x[:, 0]]), y, rcond=None)[0]
    )
    assert least_squares(rows.limit(0), 3).tolist() == [0, 0, 0]
    with pytest.raises(ValueError, match="at most"):
        least_squares(rows, 10**6)


def test_least_squares_on_sparse_text_rows(spark, labelled):
    rows = feature_rows(labelled[0], TextFeatures(16))
    found = rows.collect()
    x = np.zeros((len(found), 20))
    for i, r in enumerate(found):
        x[i, r.places] = r["values"]
    y = np.array([r.label for r in found])
    expected = np.linalg.solve(x.T @ x + 0.5 * np.eye(20), x.T @ y)
    assert least_squares(rows, 20, ridge=0.5) == pytest.approx(expected, rel=1e-8)
    errors = linear.regression_errors(rows, expected).first()
    assert errors.mse == pytest.approx(((x @ expected - y) ** 2).mean()) and errors.rmse == pytest.approx(math.sqrt(errors.mse))


STEPS = ["start", "features", "prepare", "search", "train", "register", "gate"]


class Killed(Exception):
    pass


def job(spark, base, labelled, stop_after=None, thresholds={"accuracy": 0.5}, made=None):
    def make():
        (made if made is not None else []).append(1)
        for name, part in zip(("train", "val"), labelled):
            part.write.mode("overwrite").parquet(f"{base}/features/split={name}")

    def after(step):
        if step == stop_after:
            raise Killed(step)

    s = dataclasses.replace(SETTINGS, epochs=3, warmup_ratio=0.0)
    trials = [{"learning_rate": 1e-6}, {"learning_rate": 0.8}]
    return run_training_job(spark, f"{base}/job", f"{base}/features", f"{base}/registry", thresholds, make, trials, s, TextFeatures(32), after=after)


def test_a_job_killed_after_each_step_gives_the_same_single_run(spark, labelled, tmp_path):
    base, made = str(tmp_path), []
    named = None
    for step in STEPS:
        with pytest.raises(Killed):
            job(spark, base, labelled, step, made=made)
        named = named or Ledger(spark, f"{base}/job/ledger").result("start")
        assert Ledger(spark, f"{base}/job/ledger").result("start") == named
    row = job(spark, base, labelled, made=made).collect()
    assert len(row) == 1 and spark.read.parquet(f"{base}/registry/runs").count() == 1 and made == [1]
    assert (row[0].run_id, row[0].version, row[0].passed) == (named["run_id"], named["version"], True)
    assert Ledger(spark, f"{base}/job/ledger").result("search") == {"params": {"learning_rate": 0.8}, "trial": 1}
    other = job(spark, f"{base}/second", labelled).first()
    assert [other[c] for c in ("accuracy", "f1", "precision", "recall", "loss")] == pytest.approx([row[0][c] for c in ("accuracy", "f1", "precision", "recall", "loss")])
    model = LinearTextModel.load(spark, f"{base}/registry/models/{named['version']}")
    assert model(pa.array(["good fine", "bad loud"]))[0].tolist() == [0, 1]


def test_a_run_row_written_before_the_mark_is_not_written_again(spark, labelled, tmp_path, monkeypatch):
    base = str(tmp_path)
    with pytest.raises(Killed):
        job(spark, base, labelled, "register")
    real = Ledger.once

    def breaking(self, step, work):
        if step == "gate":
            work()
            raise Killed(step)
        return real(self, step, work)

    monkeypatch.setattr(Ledger, "once", breaking)
    with pytest.raises(Killed):
        job(spark, base, labelled)
    monkeypatch.undo()
    assert job(spark, base, labelled).count() == 1 and spark.read.parquet(f"{base}/registry/runs").count() == 1


def test_job_without_features_and_aliases_of_its_runs(spark, labelled, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        run_training_job(spark, f"{base}/job", f"{base}/features", f"{base}/registry", {})
    first = job(spark, base, labelled).first()
    failed = run_training_job(spark, f"{base}/job2", f"{base}/features", f"{base}/registry", {"f1": 2.0}, settings=dataclasses.replace(SETTINGS, epochs=1), features=TextFeatures(8)).first()
    assert not failed.passed and failed.version > first.version
    assert {(r.version, r.alias) for r in aliases(spark, f"{base}/registry").collect()} == {(first.version, "champion")}
    promote(spark, f"{base}/registry", failed.version)
    assert version_of(spark, f"{base}/registry", "champion") == failed.version


def test_answers_are_one_row_per_request_in_input_order(spark):
    model = LinearTextModel(TextFeatures(), np.array([[0.0, -0.5], [0.0, 2.0], [0, 0], [0, 0]]))
    other = LinearTextModel(TextFeatures(), -model.weights)
    long, short = "x" * 400, "x"
    rows = [
        (1, [long, short, long], None, "k"), (2, [], None, "k"), (3, None, None, "k"), (4, [short, None], None, "k"), (5, ["", long], "champion", "k"),
        (6, [short] * 65, None, "k"), (7, [long], "nope", "k"), (8, [long, short], "second", "k"), (9, [short] * 64, None, "k"),
    ]
    requests = spark.createDataFrame(rows, "id int, inputs array<string>, model_version string, status_ string").coalesce(2)
    got = {r.id: r for r in answer_requests(requests, {"champion": model, "second": other}).collect()}
    assert len(got) == 9 and got[1].status_ == "k"
    assert {i: r.predictions for i, r in got.items()} == {1: [1, 0, 1], 2: None, 3: None, 4: None, 5: [0, 1], 6: None, 7: None, 8: [0, 1], 9: [0] * 64}
    assert {i: r.detail for i, r in got.items() if r.status == "error"} == {
        2: "no inputs", 3: "no inputs", 4: "an input is missing", 6: "more than 64 inputs", 7: "no model version nope"
    }
    assert all(len(r.scores) == len(r.predictions) and all(0.5 <= p <= 1 for p in r.scores) for r in got.values() if r.status == "ok")
    assert answer_requests(requests.limit(0), {"champion": model}).collect() == []
    assert answer_requests(requests, {}).where("status = 'ok'").count() == 0
