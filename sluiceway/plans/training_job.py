"""The whole training job in steps that survive a break: features, search, training, registration, gate."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.operators.evaluation import best_trial, passes_threshold
from sluiceway.operators.linear import EpochSettings, LinearTextModel, TextFeatures, best_epoch, epoch_metrics, feature_rows, fit_epochs
from sluiceway.schemas import METRIC_NAMES


class Ledger:
    """Results of a job's finished steps, one small table each below a folder.

    A step's result is written after all its effects. A step without a result is done again, so its effects
    must replace what an earlier attempt left. One job at a time works on a ledger.
    """

    def __init__(self, spark: SparkSession, path: str, after: Callable[[str], None] | None = None) -> None:
        self.spark, self.path, self.after = spark, path, after

    def result(self, step: str) -> dict | None:
        try:
            found = self.spark.read.text(f"{self.path}/{step}").first()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if found is None else json.loads(found.value)

    def once(self, step: str, work: Callable[[], dict]) -> dict:
        """The step's result, from the ledger or else from the work."""
        found = self.result(step)
        if found is None:
            found = work()
            rows = self.spark.createDataFrame([(json.dumps(found),)], "value string")
            rows.coalesce(1).write.mode("overwrite").text(f"{self.path}/{step}")
            if self.after is not None:
                self.after(step)
        return found


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def run_training_job(
    spark: SparkSession,
    job_path: str,
    features_path: str,
    models_path: str,
    thresholds: dict[str, float],
    make_features: Callable[[], object] | None = None,
    trials: list[dict] | None = None,
    settings: EpochSettings = EpochSettings(),  # noqa: B008
    features: TextFeatures = TextFeatures(words=1 << 12),  # noqa: B008
    model_name: str = "model",
    gate_options: dict | None = None,
    after: Callable[[str], None] | None = None,
) -> DataFrame:
    """The row of the run: run_id, model, version, start_time, metrics of the kept epoch, passed.

    Steps: `start` names the run; `features` calls `make_features` (such as a call of `build_features`) if
    the train split isn't there; `prepare` measures the texts of both splits; `search` trains once with each
    of the `trials` (changes to the settings) and takes the one of highest validation f1, the first of equal ones; `train` runs
    the epochs with the best settings and keeps the best; `register` stores the model as a version; `gate`
    compares its metrics with the thresholds and adds the run to the table of runs, which is the one that
    `aliases` and `promote` of `plans/training.py` read. A job that was broken off goes on after its last finished step,
    in training after its last finished epoch, and adds the same single row. `after` is called with each
    finished step.
    """
    ledger = Ledger(spark, f"{job_path}/ledger", after)
    run = ledger.once("start", lambda: {"run_id": uuid.uuid4().hex, "version": time.time_ns() // 1000})

    def built() -> dict:
        there = _exists(spark, f"{features_path}/split=train") and _exists(spark, f"{features_path}/split=val")
        if not there:
            if make_features is None:
                raise FileNotFoundError(f"no features below {features_path}, and nothing to make them with")
            make_features()
        return {"made": not there}

    ledger.once("features", built)

    def prepared() -> dict:
        for split in ("train", "val"):
            rows = feature_rows(spark.read.parquet(f"{features_path}/split={split}"), features, f"job_{split}")
            rows.write.mode("overwrite").parquet(f"{job_path}/rows/{split}")
        return {}

    ledger.once("prepare", prepared)
    train, val = (spark.read.parquet(f"{job_path}/rows/{split}") for split in ("train", "val"))

    def searched() -> dict:
        if not trials:
            return {"params": {}}
        found = []
        for i, params in enumerate(trials):
            path = f"{job_path}/trials/{i}"
            fit_epochs(train, val, features.width, path, replace(settings, **params))
            best = epoch_metrics(spark, path).where(F.col("epoch") == best_epoch(spark, path)).first()
            found.append(("search", i, best.val_f1, json.dumps(params)))
        table = spark.createDataFrame(found, "study string, trial int, f1 double, params string")
        chosen = best_trial(table, "study", "trial", "f1", ["params"]).first()
        return {"params": json.loads(chosen.params), "trial": chosen.trial}

    params = ledger.once("search", searched)["params"]
    epochs_path = f"{job_path}/epochs"

    def trained() -> dict:
        fit_epochs(train, val, features.width, epochs_path, replace(settings, **params))
        return {"epoch": best_epoch(spark, epochs_path)}

    epoch = ledger.once("train", trained)["epoch"]
    kept = epoch_metrics(spark, epochs_path).where(F.col("epoch") == epoch)

    def registered() -> dict:
        weights = fit_epochs(train, val, features.width, epochs_path, replace(settings, **params))  # all epochs are there: it only reads
        model = LinearTextModel(features, weights)
        model.save(spark, f"{models_path}/models/{run['version']}", epoch=epoch, **{k: v for k, v in asdict(replace(settings, **params)).items()})
        return {"path": f"{models_path}/models/{run['version']}"}

    ledger.once("register", registered)

    def gated() -> dict:
        named = kept.select(*[F.col(f"val_{m}").alias(m) for m in METRIC_NAMES if f"val_{m}" in kept.columns])
        full = named.select(*[(F.col(m) if m in named.columns else F.lit(None)).cast("double").alias(m) for m in METRIC_NAMES])
        gate = passes_threshold(METRIC_NAMES, thresholds, **(gate_options or {}))
        row = full.select(
            F.lit(run["run_id"]).alias("run_id"),
            F.lit(model_name).alias("model"),
            F.lit(run["version"]).cast("bigint").alias("version"),
            F.timestamp_micros(F.lit(run["version"])).alias("start_time"),
            *METRIC_NAMES,
            gate.alias("passed"),
        )
        runs = f"{models_path}/runs"
        if not _exists(spark, runs) or spark.read.parquet(runs).where(F.col("run_id") == run["run_id"]).isEmpty():
            row.coalesce(1).write.mode("append").parquet(runs)
        return {}

    ledger.once("gate", gated)
    return spark.read.parquet(f"{models_path}/runs").where(F.col("run_id") == run["run_id"])
