"""Model evaluation over prediction and metric tables: scores, gates, early stop, best and latest runs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.functions.columns import double_lit, quoted
from sluiceway.operators.ranking import exact_positions, overlapping_chunks
from sluiceway.schemas import METRIC_NAMES

# Divisor guard, early-stop patience and minimum gain, alias names.
EPSILON = 1e-9
PATIENCE = 3
MIN_DELTA = 1e-4
CHAMPION = "champion"
CHALLENGER = "challenger"

# Transitions that one task folds together.
FOLD_ROWS = 1000


def align_labels(predictions: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Predictions with their labels, matched on a key."""
    return predictions.join(labels, key)


def classification_metrics(
    df: DataFrame,
    prediction: str = "prediction",
    label: str = "label",
    groups: list[str] | None = None,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """accuracy, f1, precision, recall of class 1 and any other named aggregates, in one pass."""
    also = also or {}
    p, y = quoted(prediction), quoted(label)
    counted = df.groupBy(*(groups or [])).agg(
        F.avg((p == y).cast("double")).alias("accuracy"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        *[c.alias(name) for name, c in also.items()],
    )
    scored = counted.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp") + EPSILON)).withColumn(
        "recall", F.col("tp") / (F.col("tp") + F.col("fn") + EPSILON)
    )
    both = F.col("precision") + F.col("recall") + EPSILON
    f1 = 2 * F.col("precision") * F.col("recall") / both
    return scored.select(*(groups or []), "accuracy", f1.alias("f1"), "precision", "recall", *also)


def mean_loss(df: DataFrame, epoch: str, batch: str, loss: str) -> DataFrame:
    """Mean of the batch means per epoch: every batch weighs the same, however short."""
    return (
        df.groupBy(epoch, batch).agg(F.avg(loss).alias("_batch_loss")).groupBy(epoch).agg(F.avg("_batch_loss").alias("loss"))
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """The metrics that have a value, as (metric, value) rows."""
    present = [m for m in METRIC_NAMES if m in metrics.columns]
    wide = metrics.select(*[F.col(m).cast("double").alias(m) for m in present])
    return wide.unpivot([], present, "metric", "value").where("value is not null")


# ---- gates and choices --------------------------------------------------------------------------


def passes_threshold(
    columns: list[str],
    thresholds: dict[str, float],
    strip_prefix: str = "",
    lower_is_better: tuple[str, ...] = (),
) -> Column:
    """Whether every named metric is present and at least its minimum.

    A null metric, or a name which is no metric, fails. `strip_prefix` lets `val_f1` mean `f1`, and
    metrics in `lower_is_better` are compared the other way round; both are off by default.
    """
    known = set(columns) & set(METRIC_NAMES)
    checks = [F.lit(True)]
    for name, limit in thresholds.items():
        metric = name.removeprefix(strip_prefix)
        if metric not in known:
            return F.lit(False)
        value = quoted(metric).cast("double")
        ok = value <= limit if metric in lower_is_better else value >= limit
        checks.append(F.coalesce(ok, F.lit(False)))
    return reduce(lambda a, b: a & b, checks)


def assign_aliases(
    versions: DataFrame, gate: Column, model: str = "model", version: str = "version", order: str | None = None
) -> DataFrame:
    """model, version, alias after promoting the versions in order of `order`, by default of their numbers.

    A passing version becomes champion and the champion before it challenger, so they are the last
    two passing versions. The rank limit is applied in every task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(model).orderBy(F.desc(order or version)))
    return (
        versions.where(gate)
        .select(*dict.fromkeys([model, version, order or version]))
        .withColumn("_rank", rank)
        .where("_rank <= 2")
        .select(model, version, F.when(F.col("_rank") == 1, CHAMPION).otherwise(CHALLENGER).alias("alias"))
    )


def best_trial(
    trials: DataFrame,
    study: str,
    trial: str,
    metric: str,
    params: list[str],
    direction: str = "maximize",
) -> DataFrame:
    """The best trial per study: its number, metric and parameters.

    A null metric counts 0.0 and the earliest of equal trials wins. One aggregate with map-side combine.
    """
    value = F.coalesce(quoted(metric).cast("double"), F.lit(0.0))
    signed = value if direction == "minimize" else -value
    chosen = F.min(F.struct(signed.alias("s"), quoted(trial).alias("t"), value.alias("v"), F.struct(*params).alias("p")))
    return (
        trials.groupBy(study)
        .agg(chosen.alias("_best"))
        .select(study, F.col("_best.t").alias(trial), F.col("_best.v").alias("value"), "_best.p.*")
    )


def latest_run(runs: DataFrame, experiment: str, start_time: str, run_id: str) -> DataFrame:
    """The most recently started run per experiment; of equal starts the largest id."""
    return (
        runs.groupBy(experiment)
        .agg(F.max(F.struct(quoted(start_time).alias("s"), quoted(run_id).alias("r"))).alias("_last"))
        .select(experiment, F.col("_last.r").alias(run_id), F.col("_last.s").alias(start_time))
    )


# ---- early stop ---------------------------------------------------------------------------------


def early_stopping(
    metrics: DataFrame,
    run: str = "run",
    epoch: str = "epoch",
    loss: str = "loss",
    patience: int = PATIENCE,
    min_delta: float = MIN_DELTA,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """run, stop_epoch (null when training was never stopped), best_loss when it ended.

    The rule is a fold: the loss improves only if it lies more than `min_delta` under the best one,
    and training stops after `patience` epochs without improvement. Until then the best loss lies
    `counter + 1` epochs back, so one epoch is a function from counter to counter which needs just
    the `patience` losses before it. Such functions can be composed in any grouping: epochs are
    folded in chunks of `fold_rows`, chunks in chunks of chunks, and no run is ever one task.

    Epochs that do not count 1, 2, 3, ... in every run are numbered first.
    """
    rows = metrics.select(quoted(run).alias("run"), quoted(epoch).alias("epoch"), quoted(loss).cast("double").alias("loss"))
    counted = rows.withColumn("pos", F.col("epoch").cast("bigint") - 1)
    n, last = F.col("n"), F.col("last")
    complete = (n == last + 1) & (F.col("first") == 0) & (F.col("total") * 2 == n * last)
    longest, consecutive = (
        counted.groupBy("run")
        .agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("last"), F.min("pos").alias("first"), F.sum("pos").alias("total"))
        .agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.bool_and(complete), F.lit(True)))
        .first()
    )
    rows = counted if consecutive else exact_positions(rows, ["run"], ["epoch"])
    fold_rows = max(fold_rows, patience + 1)

    history = Window.partitionBy("run", "chunk").orderBy("pos")
    best_before = F.array(*[F.coalesce(F.lag("loss", c + 1).over(history), double_lit(math.inf)) for c in range(patience)])
    seen = overlapping_chunks(rows, "pos", fold_rows, patience).withColumn("before", best_before).where("home")
    parts = seen.select("run", F.col("pos").alias("at"), _epoch_function(patience, min_delta).alias("f"))

    while longest > 1:
        parts = (
            parts.groupBy("run", F.floor(F.col("at") / fold_rows).alias("at"))
            .agg(F.array_sort(F.collect_list(F.struct("at", "f"))).alias("fs"))
            .select("run", "at", _compose(patience).alias("f"))
        )
        longest = math.ceil(longest / fold_rows)
    end = F.col("f")[0]
    return parts.select(
        F.col("run").alias(run),
        end["stop"].alias("stop_epoch"),
        F.coalesce(end["best"], double_lit(math.inf)).alias("best_loss"),
    )


def _step(next_: Column, stop: Column, best: Column) -> Column:
    return F.struct(next_.cast("int").alias("next"), stop.cast("bigint").alias("stop"), best.cast("double").alias("best"))


def _epoch_function(patience: int, min_delta: float) -> Column:
    """Per counter 0..patience-1: the next counter, the stop epoch if reached, the best loss if it moved."""
    none = F.lit(None)
    steps = []
    for c in range(patience):
        better = F.coalesce(F.col("loss") < F.col("before")[c] - min_delta, F.lit(False))
        worse = _step(F.lit(c + 1), F.col("epoch") if c + 1 >= patience else none, none)
        steps.append(F.when(better, _step(F.lit(0), none, F.col("loss"))).otherwise(worse))
    return F.array(*steps)


def _compose(patience: int) -> Column:
    """One function for the sorted functions in `fs`; a stop that was reached stays."""
    none = F.lit(None)
    identity = F.array(*[_step(F.lit(c), none, none) for c in range(patience)])

    def then(done: Column, part: Column) -> Column:
        def follow(s: Column) -> Column:
            t = F.get(part["f"], s["next"])
            return F.when(s["stop"].isNotNull(), s).otherwise(_step(t["next"], t["stop"], F.coalesce(t["best"], s["best"])))

        return F.transform(done, follow)

    return F.aggregate(F.col("fs"), identity, then)


def best_checkpoint(metrics: DataFrame, stops: DataFrame, run: str = "run", epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    """First epoch with the lowest loss among the epochs that ran: run, epoch, loss.

    A missing, NaN or zero loss is no candidate (zero reads as "not measured"). The minimum is combined
    map-side; the join strategy is left to Spark.
    """
    value = quoted(loss).cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (value != 0)
    ran = metrics.where(usable).join(stops.select(run, "stop_epoch"), run).where(
        F.col("stop_epoch").isNull() | (quoted(epoch) <= F.col("stop_epoch"))
    )
    return (
        ran.groupBy(run)
        .agg(F.min(F.struct(value.alias("l"), quoted(epoch).alias("e"))).alias("_best"))
        .select(run, F.col("_best.e").alias(epoch), F.col("_best.l").alias(loss))
    )
