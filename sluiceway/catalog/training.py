"""Training by epochs, the whole training job, exact least squares, answers to requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import before_and_after, rounded, table
from sluiceway.catalog.features import _SPLIT
from sluiceway.operators.evaluation import best_checkpoint, early_stopping
from sluiceway.operators.linear import (
    EpochSettings,
    LinearTextModel,
    TextFeatures,
    epoch_metrics,
    feature_rows,
    fit_epochs,
    least_squares,
    numeric_rows,
    regression_errors,
)
from sluiceway.operators.serving import answer_requests
from sluiceway.operators.split import with_split
from sluiceway.plans.training_job import run_training_job
from sluiceway.session import scratch_path

EPOCHS = EpochSettings(epochs=12, learning_rate=2.0, patience=3)
TRIALS = [{"learning_rate": 0.05}, {"learning_rate": 2.0}]
GATE = {"accuracy": 0.5, "f1": 0.99}


def _splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    documents = with_split(table(spark, sf_dir, "documents").select("doc_id", "text"), id_col="doc_id")
    labelled = documents.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    return {name: labelled.where(F.col("split") == name).select("text", "label") for name in ("train", "val")}


def _epochs(spark: SparkSession, sf_dir: str) -> tuple[str, LinearTextModel]:
    features, path = TextFeatures(), scratch_path(spark, "epochs")
    train, val = (feature_rows(rows, features) for rows in _splits(spark, sf_dir).values())
    return path, LinearTextModel(features, fit_epochs(train, val, features.width, path, EPOCHS))


def epoch_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All epochs of a run, and which one is kept by the choice over the run's own metrics."""
    path, _ = _epochs(spark, sf_dir)
    metrics = epoch_metrics(spark, path).withColumn("run", F.lit(1))
    kept = best_checkpoint(metrics, early_stopping(metrics, loss="val_loss"), loss="val_loss").select(F.col("epoch").alias("kept_epoch"))
    scores = [rounded(c) for c in ("train_loss", "val_loss", "val_accuracy", "val_f1")]
    return metrics.join(kept, F.lit(True), "left").select("epoch", *scores, (F.col("epoch") == F.col("kept_epoch")).alias("kept"))


def training_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From documents and labels to the gated run: features are missing at first, two learning rates are tried."""
    base = scratch_path(spark, "job")

    def make() -> None:
        for name, rows in _splits(spark, sf_dir).items():
            rows.write.mode("overwrite").parquet(f"{base}/features/split={name}")

    row = run_training_job(
        spark, f"{base}/job", f"{base}/features", f"{base}/registry", GATE, make, TRIALS, EPOCHS, TextFeatures()
    )
    return row.select("model", *[rounded(c) for c in ("accuracy", "f1", "precision", "recall")], "passed")


def request_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as requests with a text per turn; every tenth has no inputs, a missing one, or an unknown version."""
    _, model = _epochs(spark, sf_dir)
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    requests = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("inputs"))
    case = F.col("conv_id") % 10
    broken = F.when(case == 0, F.array().cast("array<string>")).when(case == 1, F.concat("inputs", F.array(F.lit(None).cast("string")))).otherwise(F.col("inputs"))
    requests = requests.select("conv_id", broken.alias("inputs"), F.when(case == 2, "v9").alias("model_version"))
    answers = answer_requests(requests, {"champion": model})
    return answers.select("conv_id", "model_version", "status", F.array_join("predictions", ",").alias("predictions"), "detail")


def least_squares_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price by quantity and discount, fitted before the cut-off date and judged after it."""
    before, after = (numeric_rows(x, ["l_quantity", "l_discount"], "l_extendedprice") for x in before_and_after(table(spark, sf_dir, "lineitem"), "l_shipdate"))
    found = least_squares(before, 3)
    names = ("intercept", "by_quantity", "by_discount")
    errors = regression_errors(after, found).withColumns({n: F.lit(float(x)) for n, x in zip(names, found)})
    return errors.select(*[rounded(n, 4) for n in names], rounded("mse", 2), rounded("rmse", 4))


QUERIES = {
    "epoch_training": epoch_training,
    "training_job": training_job,
    "request_answers": request_answers,
    "least_squares": least_squares_fit,
}

_MEASURES = """[1.0::DOUBLE, ln(1 + length(text)) / 10, (length(text) - length(replace(text, ' ', ''))) / greatest(length(text), 1)::DOUBLE,
                (length(text) - length(replace(text, '.', ''))) / greatest(length(text), 1)::DOUBLE]"""


def _epochs_sql(rates: list[float]) -> str:
    """CTEs of all epochs that ran: `ran` (trial, epoch, w and the metrics) and `kept`."""
    s = EPOCHS
    trials = ", ".join(f"({i}, {x}::DOUBLE)" for i, x in enumerate(rates))
    zeros = "[0.0::DOUBLE, 0.0, 0.0, 0.0]"
    means = ", ".join(f"avg((p - y) * x[{i}])" for i in range(1, 5))
    return f"""{_SPLIT},
    rows_ AS (SELECT split, quality::DOUBLE AS y, {_MEASURES} AS x FROM documents JOIN labels USING (doc_id) JOIN labelled USING (doc_id)),
    trials(trial, rate) AS (VALUES {trials}),
    epochs AS (
        SELECT trial, rate, 0 AS epoch, {zeros} AS w, {zeros} AS m, {zeros} AS v, 0.0::DOUBLE AS train_loss FROM trials
        UNION ALL
        SELECT trial, rate, t, list_transform(range(1, 5), lambda i: w[i] * (1 - r * {s.weight_decay})
                   - r * (m2[i] / (1 - pow({s.beta1}, t))) / (sqrt(v2[i] / (1 - pow({s.beta2}, t))) + {s.eps})), m2, v2, loss
        FROM (SELECT trial, rate, epoch + 1 AS t, rate * ({s.epochs} - epoch) / {s.epochs} AS r, w, loss,
                     list_transform(range(1, 5), lambda i: {s.beta1} * m[i] + (1 - {s.beta1}) * g[i]) AS m2,
                     list_transform(range(1, 5), lambda i: {s.beta2} * v[i] + (1 - {s.beta2}) * g[i] * g[i]) AS v2
              FROM (SELECT trial, rate, epoch, any_value(w) AS w, any_value(m) AS m, any_value(v) AS v, [{means}] AS g,
                           avg(-ln(greatest(1e-15, CASE WHEN y = 1 THEN p ELSE 1 - p END))) AS loss
                    FROM (SELECT e.*, x, y, 1 / (1 + exp(-2 * list_dot_product(e.w, x))) AS p
                          FROM epochs e, rows_ WHERE split = 'train' AND epoch < {s.epochs})
                    GROUP BY trial, rate, epoch))),
    judged AS (
        SELECT trial, epoch, any_value(w) AS w, any_value(train_loss) AS train_loss,
               avg(-ln(greatest(1e-15, CASE WHEN y = 1 THEN p ELSE 1 - p END))) AS val_loss,
               avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) FILTER (WHERE p > 0.5 AND y = 1) AS tp,
               count(*) FILTER (WHERE p > 0.5 AND y = 0) AS fp, count(*) FILTER (WHERE p <= 0.5 AND y = 1) AS fn
        FROM (SELECT e.*, y, 1 / (1 + exp(-2 * list_dot_product(e.w, x))) AS p FROM epochs e, rows_ WHERE split = 'val' AND epoch > 0)
        GROUP BY trial, epoch),
    folded AS (
        SELECT trial, 0 AS epoch, 'inf'::DOUBLE AS best, 0 AS waited FROM trials
        UNION ALL
        SELECT f.trial, j.epoch, CASE WHEN j.val_loss < f.best - {s.min_delta} THEN j.val_loss ELSE f.best END,
               CASE WHEN j.val_loss < f.best - {s.min_delta} THEN 0 ELSE f.waited + 1 END
        FROM folded f JOIN judged j ON j.trial = f.trial AND j.epoch = f.epoch + 1 WHERE f.waited < {s.patience}),
    scored AS (SELECT *, tp / (tp + fp + 1e-9) AS prec, tp / (tp + fn + 1e-9) AS rec FROM judged JOIN folded USING (trial, epoch)),
    ran AS (SELECT *, 2 * prec * rec / (prec + rec + 1e-9) AS f1,
                   row_number() OVER (PARTITION BY trial ORDER BY val_loss, epoch) = 1 AS kept FROM scored)"""


ORACLES = {
    "epoch_training": f"""
        WITH RECURSIVE {_epochs_sql([EPOCHS.learning_rate])}
        SELECT epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, round(accuracy, 6) AS val_accuracy,
               round(f1, 6) AS val_f1, kept FROM ran""",
    "training_job": f"""
        WITH RECURSIVE {_epochs_sql([t["learning_rate"] for t in TRIALS])}
        SELECT 'model' AS model, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(prec, 6) AS precision, round(rec, 6) AS recall,
               accuracy >= {GATE["accuracy"]} AND f1 >= {GATE["f1"]} AS passed
        FROM ran WHERE kept ORDER BY ran.f1 DESC, trial LIMIT 1""",
    "request_answers": f"""
        WITH RECURSIVE {_epochs_sql([EPOCHS.learning_rate])},
        guessed AS (SELECT conv_id, turn, CASE WHEN 1 / (1 + exp(-2 * list_dot_product(w, {_MEASURES}))) > 0.5 THEN 1 ELSE 0 END AS guess
                    FROM (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations), ran WHERE kept),
        answers AS (SELECT conv_id, string_agg(guess, ',' ORDER BY turn) AS predictions, count(*) AS n FROM guessed GROUP BY conv_id),
        told AS (SELECT *, CASE WHEN conv_id % 10 = 0 THEN 'no inputs'
                        WHEN n + (conv_id % 10 = 1)::INT > 64 THEN 'more than 64 inputs'
                        WHEN conv_id % 10 = 1 OR conv_id IN (SELECT conv_id FROM conversations WHERE text IS NULL) THEN 'an input is missing'
                        WHEN conv_id % 10 = 2 THEN 'no model version v9' END AS detail FROM answers)
        SELECT conv_id, CASE WHEN conv_id % 10 = 2 THEN 'v9' ELSE 'champion' END AS model_version,
               CASE WHEN detail IS NULL THEN 'ok' ELSE 'error' END AS status, CASE WHEN detail IS NULL THEN predictions END AS predictions, detail
        FROM told""",
    "least_squares": """
        WITH b AS (SELECT l_extendedprice AS y, l_quantity AS q, l_discount AS d FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'),
        s AS (SELECT var_pop(q) AS qq, var_pop(d) AS dd, covar_pop(q, d) AS qd, covar_pop(q, y) AS qy, covar_pop(d, y) AS dy,
                     avg(q) AS q, avg(d) AS d, avg(y) AS y FROM b),
        c AS (SELECT (dd * qy - qd * dy) / (qq * dd - qd * qd) AS by_quantity, (qq * dy - qd * qy) / (qq * dd - qd * qd) AS by_discount, q, d, y FROM s),
        f AS (SELECT by_quantity, by_discount, y - by_quantity * q - by_discount * d AS intercept FROM c),
        e AS (SELECT avg(pow(intercept + by_quantity * l_quantity + by_discount * l_discount - l_extendedprice, 2)) AS mse
              FROM lineitem, f WHERE l_shipdate >= TIMESTAMP '1998-06-01')
        SELECT round(intercept, 4) AS intercept, round(by_quantity, 4) AS by_quantity, round(by_discount, 4) AS by_discount,
               round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse FROM f, e""",
}
