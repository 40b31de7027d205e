"""Features to a gated model."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.operators.evaluation import CHAMPION, assign_aliases, metric_rows, passes_threshold
from sluiceway.operators.models import evaluate_classifier, train_text_classifier
from sluiceway.schemas import METRIC_NAMES


def train_and_gate(
    spark: SparkSession,
    features_path: str,
    models_path: str,
    thresholds: dict[str, float],
    model_name: str = "model",
    gate_options: dict | None = None,
    **params,
) -> DataFrame:
    """Train on the train split, score on the validation split, record the version, gate it.

    Returns the row of the run: run_id, model, version, start_time, metrics, passed. The model lies
    under `models_path`/models, the run in the table `models_path`/runs.
    """
    train = spark.read.parquet(f"{features_path}/split=train")
    val = spark.read.parquet(f"{features_path}/split=val")
    started = time.time()
    model = train_text_classifier(train, **params)
    metrics = evaluate_classifier(model, val)
    # Versions are start times in microseconds: increasing, and no read of the table is needed.
    version = int(started * 1e6)
    model.write().overwrite().save(f"{models_path}/models/{version}")
    gate = passes_threshold(METRIC_NAMES, thresholds, **(gate_options or {}))
    full = metrics.select(
        *[(F.col(m) if m in metrics.columns else F.lit(None)).cast("double").alias(m) for m in METRIC_NAMES]
    )
    full.select(
        F.lit(uuid.uuid4().hex).alias("run_id"),
        F.lit(model_name).alias("model"),
        F.lit(version).cast("bigint").alias("version"),
        F.timestamp_micros(F.lit(version)).alias("start_time"),
        *METRIC_NAMES,
        gate.alias("passed"),
    ).write.mode("append").parquet(f"{models_path}/runs")
    return spark.read.parquet(f"{models_path}/runs").where(F.col("version") == version)


def promote(spark: SparkSession, models_path: str, version: int, model_name: str = "model") -> None:
    """Make a stored version the champion whatever its gate said: a promotion or, of an older one, a rollback."""
    known = spark.read.parquet(f"{models_path}/runs").where((F.col("version") == version) & (F.col("model") == model_name))
    if known.isEmpty():
        raise ValueError(f"no version {version} of {model_name}")
    spark.createDataFrame(
        [(model_name, version, int(time.time() * 1e6))], "model string, version bigint, at bigint"
    ).coalesce(1).write.mode("append").parquet(f"{models_path}/promotions")


def aliases(spark: SparkSession, models_path: str) -> DataFrame:
    """Champion and challenger of each model: model, version, alias.

    A run that passes its gate is promoted when it starts, others when `promote` says so. The version
    promoted last is the champion, the other version promoted last before it the challenger.
    """
    runs = spark.read.parquet(f"{models_path}/runs").where("passed").select("model", "version", F.col("version").alias("at"))
    try:
        events = runs.unionByName(spark.read.parquet(f"{models_path}/promotions"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        events = runs
    latest = events.groupBy("model", "version").agg(F.max(F.struct("at", "version")).alias("promoted"))
    return assign_aliases(latest, F.lit(True), order="promoted")


def version_of(spark: SparkSession, models_path: str, alias: str, model_name: str = "model") -> int:
    """The version that an alias stands for now."""
    held = aliases(spark, models_path).where((F.col("alias") == alias) & (F.col("model") == model_name)).first()
    if held is None:
        raise ValueError(f"no {alias} of {model_name}")
    return held.version


def load_version(models_path: str, version: int | str = CHAMPION, model_name: str = "model") -> PipelineModel:
    """A stored version, by its number or by its alias."""
    if isinstance(version, str):
        version = version_of(SparkSession.active(), models_path, version, model_name)
    return PipelineModel.load(f"{models_path}/models/{version}")


def evaluate_version(models_path: str, version: int | str, test: DataFrame, model_name: str = "model") -> DataFrame:
    """(metric, value) rows of a stored version, by number or alias, on a labelled table."""
    return metric_rows(evaluate_classifier(load_version(models_path, version, model_name), test))
