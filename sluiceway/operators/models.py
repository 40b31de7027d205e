"""Text models on distributed Spark ML: training, scoring, parameter search, evaluation."""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions.text import BETWEEN_WORDS
from sluiceway.operators.evaluation import classification_metrics
from sluiceway.session import scratch_path

# Fixed values of the search space: regularisation (log scale), mixing, iterations.
REG_RANGE = (1e-6, 1e-1)
MIX_RANGE = (0.0, 1.0)
ITERATION_RANGE = (2, 8)


def text_and_label(df: DataFrame) -> tuple[str, str]:
    """Column `text` or else the first one; column `label` or else the last one."""
    return (
        "text" if "text" in df.columns else df.columns[0],
        "label" if "label" in df.columns else df.columns[-1],
    )


def count_words(text: str, dimensions: int) -> PipelineModel:
    """Stages from text to hashed word counts in `_tf`; they need no fit."""
    return PipelineModel(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=BETWEEN_WORDS),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dimensions),
        ]
    )


def _stored(model):
    """The model as read back from the shared folder.

    A freshly trained model drags its training summary, and with it the session, into every task;
    the stored one holds the coefficients alone.
    """
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def _train_on_text(train: DataFrame, dimensions: int, head) -> PipelineModel:
    """Word counts, their weights and a model on top. The texts are split once: the counts are kept
    while the weights and the model are fitted on them."""
    text, label = text_and_label(train)
    counting = count_words(text, dimensions)
    counts = counting.transform(train).select(F.col(label).cast("double").alias("_label"), "_tf").persist()
    try:
        weights = IDF(inputCol="_tf", outputCol="features").fit(counts)
        model = head.fit(weights.transform(counts))
    finally:
        counts.unpersist()
    return _stored(PipelineModel(stages=[*counting.stages, weights, model]))


def train_text_classifier(train: DataFrame, dimensions: int = 1 << 16, **params) -> PipelineModel:
    """Logistic regression over text; every stage aggregates on the executors."""
    options = {"maxIter": 20, "regParam": 1e-3} | params
    return _train_on_text(train, dimensions, LogisticRegression(labelCol="_label", **options))


def train_text_regressor(train: DataFrame, dimensions: int = 1 << 12, **params) -> PipelineModel:
    """Linear regression over text, squared loss."""
    options = {"maxIter": 20, "regParam": 1e-1, "solver": "l-bfgs"} | params
    return _train_on_text(train, dimensions, LinearRegression(labelCol="_label", **options))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring: the input columns and `prediction` (and `probability` where there is one)."""
    scored = model.transform(df)
    extra = ["probability"] if "probability" in scored.columns else []
    return scored.select(*df.columns, "prediction", *extra)


def evaluate_classifier(model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row of metrics on a labelled table, with the mean log loss."""
    _, label = text_and_label(test)
    scored = score(model, test).withColumn("_label", F.col(label).cast("int"))
    chance = F.get(vector_to_array("probability"), F.col("_label"))
    nll = -F.ln(F.greatest(F.coalesce(chance, F.lit(0.0)), F.lit(1e-15)))
    judged = scored.select(F.col("prediction").cast("int").alias("prediction"), "_label", nll.alias("_nll"))
    return classification_metrics(judged, "prediction", "_label", also={"loss": F.avg("_nll")})


def evaluate_regressor(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Mean squared error and its root."""
    _, label = text_and_label(test)
    gap = F.col("prediction") - F.col(label).cast("double")
    return score(model, test).agg(F.avg(gap * gap).alias("mse")).select("mse", F.sqrt("mse").alias("rmse"))


def sample_parameters(trials: int, seed: int) -> list[dict]:
    """Random points of the search space."""
    draw = random.Random(seed)
    low, high = (math.log(x) for x in REG_RANGE)
    return [
        {
            "regParam": math.exp(draw.uniform(low, high)),
            "elasticNetParam": draw.uniform(*MIX_RANGE),
            "maxIter": draw.randint(*ITERATION_RANGE),
        }
        for _ in range(trials)
    ]


def search_parameters(
    train: DataFrame, val: DataFrame, trials: int = 20, seed: int = 42, parallelism: int = 4, dimensions: int = 1 << 14
) -> DataFrame:
    """Trials table: trial, the parameters, and the metrics on the validation table.

    The text features are fitted once; `parallelism` distributed fits run side by side.
    """
    spark = train.sparkSession
    text, label = text_and_label(train)
    counting = count_words(text, dimensions)
    wanted = [F.col(label).cast("double").alias("_label"), "_tf"]
    fit_counts = counting.transform(train).select(*wanted).persist()
    val_counts = counting.transform(val).select(*wanted).persist()
    weights = IDF(inputCol="_tf", outputCol="features").fit(fit_counts)
    fitted_on, judged_on = weights.transform(fit_counts), weights.transform(val_counts)

    def run(trial: tuple[int, dict]) -> tuple:
        number, params = trial
        model = _stored(LogisticRegression(labelCol="_label", **params).fit(fitted_on))
        scored = model.transform(judged_on).select(
            F.col("prediction").cast("int").alias("prediction"), F.col("_label").cast("int").alias("_label")
        )
        m = classification_metrics(scored, "prediction", "_label").first()
        return number, params["regParam"], params["elasticNetParam"], params["maxIter"], m.accuracy, m.f1, m.precision, m.recall

    try:
        with ThreadPool(parallelism) as pool:
            rows = pool.map(inheritable_thread_target(spark)(run), list(enumerate(sample_parameters(trials, seed))))
    finally:
        fit_counts.unpersist()
        val_counts.unpersist()
    return spark.createDataFrame(
        rows,
        "trial int, reg_param double, elastic_net double, max_iter int, accuracy double, f1 double, precision double, recall double",
    )
