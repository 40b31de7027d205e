"""Scores, gates, early stop, choices; table profiles; models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import MEASURES, rounded, table
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
from sluiceway.operators.models import (
    evaluate_classifier,
    evaluate_regressor,
    score,
    search_parameters,
    train_text_classifier,
    train_text_regressor,
)
from sluiceway.operators.profile import describe, null_profile, numeric_histogram, preview, value_counts
from sluiceway.operators.split import split
from sluiceway.plans.training import evaluate_version, train_and_gate
from sluiceway.session import scratch_path

GATE = {"f1": 0.51, "accuracy": 0.95}


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule as the model: long documents are taken for good ones."""
    guess = F.when(F.col("n_chars") >= 1500, 1).otherwise(0)
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", guess.alias("prediction"))
    return align_labels(documents, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification_metrics(_predicted(spark, sf_dir))


def metrics_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select(*[rounded(c) for c in ("accuracy", "f1", "precision", "recall")])


def metrics_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(_scores(spark, sf_dir)).select("metric", rounded("value"))


def batch_mean_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("epoch"), F.col("l_suppkey").alias("batch"), F.col("l_discount").alias("step_loss")
    )
    return mean_loss(steps, "epoch", "batch", "step_loss").select("epoch", rounded("loss"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per supplier, its line items as the measurements."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("version"))
        .agg(
            F.round(1 - F.avg("l_discount"), 6).alias("accuracy"),
            F.round(F.avg("l_quantity") / 50, 6).alias("f1"),
            F.round(F.avg("l_tax"), 6).alias("loss"),
        )
        .withColumn("model", F.concat(F.lit("model_"), F.col("version") % 5))
    )


def threshold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _versions(spark, sf_dir)
    return versions.select(
        "version",
        passes_threshold(versions.columns, GATE).alias("passes"),
        passes_threshold(versions.columns, {"auc": 0.5}).alias("passes_unmeasured"),
        passes_threshold(versions.columns, {"val_f1": 0.51, "val_loss": 0.04}, "val_", ("loss",)).alias("passes_prefixed"),
    )


def champion_challenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _versions(spark, sf_dir)
    return assign_aliases(versions, passes_threshold(versions.columns, {"f1": 0.5}))


def trial_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trials: the priority is the study, the price the metric, missing for some."""
    metric = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    trials = table(spark, sf_dir, "orders").withColumn("metric", metric)
    return best_trial(trials, "o_orderpriority", "o_orderkey", "metric", ["o_custkey", "o_orderstatus"])


def trial_choice_lowest(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = table(spark, sf_dir, "orders")
    return best_trial(trials, "o_orderpriority", "o_orderkey", "o_totalprice", ["o_custkey"], "minimize")


def run_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = latest_run(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")
    return runs.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("started"))


def _epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as training runs, line numbers as epochs, mean discount as the loss."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("run"), F.col("l_linenumber").alias("epoch"))
        .agg(F.round(F.avg("l_discount"), 6).alias("loss"))
    )


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stopping(_epochs(spark, sf_dir))


def checkpoint_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    epochs = _epochs(spark, sf_dir)
    return best_checkpoint(epochs, early_stopping(epochs))


# ---- profiles -----------------------------------------------------------------------------------


def value_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "labels"), "quality")


def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return null_profile(joined).select("column", rounded("null_pct"))


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = numeric_histogram(table(spark, sf_dir, "lineitem"), MEASURES)
    return found.select("column", "bin", rounded("lower"), rounded("upper"), "rows")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = describe(table(spark, sf_dir, "lineitem"), MEASURES)
    return found.select("column", "count", *[rounded(c, 4) for c in found.columns[2:]])


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(orders.columns)).alias("columns"))


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five orders, with the shape of the table."""
    (rows, columns), first = preview(table(spark, sf_dir, "orders").orderBy("o_orderkey"))
    return first.select("o_orderkey", "o_totalprice", F.lit(rows).cast("bigint").alias("rows"), F.lit(columns).alias("columns"))


# ---- models -------------------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


def text_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the train split, metrics on the test split."""
    train, _, test = split(_labelled(spark, sf_dir), id_col="doc_id")
    return evaluate_classifier(train_text_classifier(train, dimensions=1 << 12), test)


def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a classifier trained on the labelled ones."""
    model = train_text_classifier(_labelled(spark, sf_dir).drop("doc_id"), dimensions=1 << 12)
    return score(model, table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "prediction")


def text_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.log1p("n_chars").alias("label"))
    train, _, test = split(documents, id_col="doc_id")
    return evaluate_regressor(train_text_regressor(train, dimensions=1 << 10), test)


def parameter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val, _ = split(_labelled(spark, sf_dir), id_col="doc_id")
    trials = search_parameters(train, val, trials=4, dimensions=1 << 12).withColumn("study", F.lit("search"))
    return best_trial(trials, "study", "trial", "f1", ["reg_param", "elastic_net", "max_iter"])


def version_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training job; the champion is then evaluated on the test split."""
    base = scratch_path(spark, "training")
    parts = dict(zip(("train", "val", "test"), split(_labelled(spark, sf_dir), id_col="doc_id")))
    for name, part in parts.items():
        part.write.parquet(f"{base}/features/split={name}")
    train_and_gate(spark, f"{base}/features", base, {"accuracy": 0.1}, dimensions=1 << 12).count()
    return evaluate_version(base, "champion", spark.read.parquet(f"{base}/features/split=test"))


QUERIES = {
    "classification_metrics": metrics_overall,
    "metric_rows": metrics_listed,
    "batch_mean_loss": batch_mean_loss,
    "threshold_gate": threshold_gate,
    "champion_challenger": champion_challenger,
    "best_trial": trial_choice,
    "best_trial_lowest": trial_choice_lowest,
    "latest_run": run_choice,
    "early_stopping": early_stop,
    "best_checkpoint": checkpoint_choice,
    "value_counts": value_shares,
    "null_profile": nulls,
    "numeric_histogram": histogram,
    "describe": summary,
    "table_shape": table_shape,
    "preview": preview_orders,
    "train_text_classifier": text_classifier,
    "batch_scoring": batch_scoring,
    "train_text_regressor": text_regressor,
    "hpo_search": parameter_search,
    "evaluate_version": version_evaluation,
}

_PREDICTED = """
    seen AS (SELECT CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS p, quality AS y FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT avg(CASE WHEN p = y THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) FILTER (WHERE p = 1 AND y = 1) AS tp,
                 count(*) FILTER (WHERE p = 1 AND y = 0) AS fp, count(*) FILTER (WHERE p = 0 AND y = 1) AS fn FROM seen),
    pr AS (SELECT accuracy, tp / (tp + fp + 1e-9) AS p, tp / (tp + fn + 1e-9) AS r FROM c),
    m AS (SELECT round(accuracy, 6) AS accuracy, round(2 * p * r / (p + r + 1e-9), 6) AS f1, round(p, 6) AS precision,
                 round(r, 6) AS recall FROM pr)"""
_VERSIONS = """
    v AS (SELECT l_suppkey AS version, round(1 - avg(l_discount), 6) AS accuracy, round(avg(l_quantity) / 50, 6) AS f1,
                 round(avg(l_tax), 6) AS loss, 'model_' || (l_suppkey % 5) AS model
          FROM lineitem GROUP BY l_suppkey)"""
_STOPS = """
    e AS (SELECT l_suppkey AS run, l_linenumber AS epoch, round(avg(l_discount), 6) AS loss FROM lineitem GROUP BY 1, 2),
    steps AS (
        SELECT DISTINCT run, 0 AS epoch, 'inf'::DOUBLE AS best, 0 AS counter FROM e
        UNION ALL
        SELECT s.run, e.epoch, CASE WHEN e.loss < s.best - 1e-4 THEN e.loss ELSE s.best END,
               CASE WHEN e.loss < s.best - 1e-4 THEN 0 ELSE s.counter + 1 END
        FROM steps s JOIN e ON e.run = s.run AND e.epoch = s.epoch + 1 WHERE s.counter < 3),
    ended AS (SELECT run, max(epoch) AS last, arg_max(best, epoch) AS best_loss, arg_max(counter, epoch) AS counter
              FROM steps GROUP BY run)"""
_LONG = """
    long AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS col,
                    unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v FROM lineitem)"""

ORACLES = {
    "classification_metrics": f"WITH {_PREDICTED} SELECT * FROM m",
    "metric_rows": f"""
        WITH {_PREDICTED}
        SELECT unnest(['accuracy', 'f1', 'precision', 'recall']) AS metric, unnest([accuracy, f1, precision, recall]) AS value FROM m""",
    "batch_mean_loss": """
        SELECT epoch, round(avg(b), 6) AS loss
        FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS epoch, l_suppkey, avg(l_discount) AS b FROM lineitem GROUP BY 1, 2) GROUP BY epoch""",
    "threshold_gate": f"""
        WITH {_VERSIONS}
        SELECT version, f1 >= 0.51 AND accuracy >= 0.95 AS passes, false AS passes_unmeasured,
               f1 >= 0.51 AND loss <= 0.04 AS passes_prefixed FROM v""",
    "champion_challenger": f"""
        WITH {_VERSIONS},
        r AS (SELECT model, version, row_number() OVER (PARTITION BY model ORDER BY version DESC) AS n FROM v WHERE f1 >= 0.5)
        SELECT model, version, CASE n WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias FROM r WHERE n <= 2""",
    "best_trial": """
        WITH t AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0.0 END AS m FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY m DESC, o_orderkey) AS n FROM t)
        SELECT o_orderpriority, o_orderkey, m AS value, o_custkey, o_orderstatus FROM r WHERE n = 1""",
    "best_trial_lowest": """
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS n
                   FROM orders)
        SELECT o_orderpriority, o_orderkey, o_totalprice AS value, o_custkey FROM r WHERE n = 1""",
    "latest_run": """
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
        SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS started FROM r WHERE n = 1""",
    "early_stopping": f"""
        WITH RECURSIVE {_STOPS}
        SELECT run, CAST(CASE WHEN counter >= 3 THEN last END AS BIGINT) AS stop_epoch, best_loss FROM ended""",
    "best_checkpoint": f"""
        WITH RECURSIVE {_STOPS},
        r AS (SELECT e.*, row_number() OVER (PARTITION BY run ORDER BY loss, epoch) AS n
              FROM e JOIN ended USING (run) WHERE epoch <= last)
        SELECT run, epoch, loss FROM r WHERE n = 1""",
    "value_counts": """
        SELECT quality AS value, count(*) AS "rows", round(count(*) / (SELECT count(quality) FROM labels), 3) AS share
        FROM labels WHERE quality IS NOT NULL GROUP BY quality""",
    "null_profile": """
        WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
        p AS (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars', 'quality', 'toxic']) AS "column",
                     unnest([count(doc_id), count(text), count(lang), count(source), count(n_chars), count(quality), count(toxic)]) AS c,
                     count(*) AS n FROM j)
        SELECT "column", round((n - c) * 100.0::DOUBLE / n, 6) AS null_pct FROM p WHERE c < n""",
    "numeric_histogram": f"""
        WITH {_LONG},
        span AS (SELECT col, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 30 AS w FROM long GROUP BY col),
        placed AS (SELECT col, list_sum(list_transform(range(1, 30), lambda i: CASE WHEN v >= lo + i * w THEN 1 ELSE 0 END)) AS bin
                   FROM long JOIN span USING (col)),
        counts AS (SELECT col, bin, count(*) AS n FROM placed GROUP BY col, bin)
        SELECT col AS "column", CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper,
               coalesce(n, 0) AS "rows"
        FROM (SELECT *, unnest(range(0, 30)) AS bin FROM span) LEFT JOIN counts USING (col, bin)""",
    "describe": f"""
        WITH {_LONG}
        SELECT col AS "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min,
               round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75,
               round(max(v), 4) AS max
        FROM long GROUP BY col""",
    "table_shape": """SELECT count(*) AS "rows", 6 AS columns FROM orders""",
    "preview": """
        SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS "rows", 6 AS columns
        FROM orders ORDER BY o_orderkey LIMIT 5""",
}
