"""Linear models over text trained by passes of their own: epochs with early stop and kept best, exact least squares.

A pass is one scan: every task adds up its Arrow batches' sums as arrays, and the tasks' arrays are added in
rounds of at most `FAN` to one, so the driver receives one array whatever the number of tasks.
"""

from __future__ import annotations

import math
import re
import time
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway.operators.evaluation import EPSILON, MIN_DELTA, PATIENCE
from sluiceway.operators.models import text_and_label
from sluiceway.session import to_scratch_table

# Tasks' arrays that one task adds up, and numbers of an array that travel together.
FAN = 64
SLAB = 1 << 14
# Least squares keeps a matrix of width * width numbers in every task and on the driver.
MAX_WIDTH = 2048

_WORD = re.compile(r"\S+")
#: The measures of every text: one, logarithm of the characters, shares of spaces and of full stops.
MEASURES = 4


@dataclass(frozen=True)
class TextFeatures:
    """Measures of a text and, after them, `words` places for hashed words (lower case, CRC-32; 1 + log count, unit length).

    A null text is an empty one.
    """

    words: int = 0

    @property
    def width(self) -> int:
        return MEASURES + self.words

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, values, first value of each text and the end)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)
        rows = [np.ones(n), np.log1p(chars) / 10]
        rows += [pc.count_substring(texts, x).to_numpy(zero_copy_only=False) / np.maximum(chars, 1) for x in (" ", ".")]
        measures = np.column_stack(rows)
        if not self.words:
            return np.tile(np.arange(MEASURES), n), measures.ravel(), np.arange(n + 1) * MEASURES
        places, values, sizes = [], [], []
        known: dict[str, int] = {}
        for i, text in enumerate(texts.to_pylist()):
            counts: dict[int, int] = {}
            for word in _WORD.findall(text.lower()):
                place = known.get(word)
                if place is None:
                    place = known[word] = MEASURES + zlib.crc32(word.encode()) % self.words
                counts[place] = counts.get(place, 0) + 1
            own = 1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
            places += [np.arange(MEASURES), np.fromiter(counts, dtype=np.int64, count=len(counts))]
            values += [measures[i], own / math.sqrt((own * own).sum()) if len(own) else own]
            sizes.append(MEASURES + len(counts))
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(1, dtype=np.int64)
        return np.concatenate(places), np.concatenate(values), np.concatenate([[0], np.cumsum(sizes)])


ROWS = "label double, places array<int>, values array<double>"


def feature_rows(df: DataFrame, features: TextFeatures, name: str = "feature_rows") -> DataFrame:
    """Stored (label, places, values) of every row with a label; epochs read it again without the texts."""
    text, label = text_and_label(df)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values, first = features(batch["text"])
            border = pa.array(first.astype(np.int32))
            lists = [pa.ListArray.from_arrays(border, pa.array(x)) for x in (places.astype(np.int32), values)]
            yield pa.record_batch([batch["label"], *lists], ["label", "places", "values"])

    rows = df.select(F.col(label).cast("double").alias("label"), F.col(text).alias("text")).where("label IS NOT NULL AND NOT isnan(label)")
    return to_scratch_table(rows.mapInArrow(made, ROWS), name)


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(labels, row of each value, places, values) of a batch of feature rows."""
    places = batch["places"]
    row = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
    return batch["label"].to_numpy(), row, places.flatten().to_numpy().astype(np.int64), batch["values"].flatten().to_numpy()


_PARTS = "bucket long, slab int, numbers binary"


def added_up(rows: DataFrame, of_batch, size: int) -> np.ndarray:
    """Sum of `of_batch`'s arrays of `size` numbers over all batches of all tasks."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(batch)
        slabs = range(0, size, SLAB)
        yield pa.record_batch(
            [
                pa.array([TaskContext.get().partitionId()] * len(slabs), pa.int64()),
                pa.array(range(len(slabs)), pa.int32()),
                pa.array([total[a : a + SLAB].tobytes() for a in slabs], pa.binary()),
            ],
            ["bucket", "slab", "numbers"],
        )

    def summed(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.float64) for x in table["numbers"].to_pylist())
        return pa.table([table["bucket"].slice(0, 1), table["slab"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["bucket", "slab", "numbers"])

    tasks = rows.rdd.getNumPartitions()
    parts = rows.mapInArrow(scanned, _PARTS)
    while tasks > FAN:
        parts = parts.withColumn("bucket", F.floor(F.col("bucket") / FAN)).groupBy("bucket", "slab").applyInArrow(summed, _PARTS)
        tasks = math.ceil(tasks / FAN)
    parts = parts.groupBy("slab").applyInArrow(summed, _PARTS)
    found = {r.slab: np.frombuffer(r.numbers, dtype=np.float64) for r in parts.select("slab", "numbers").collect()}
    return np.concatenate([found[i] for i in range(len(found))]) if found else np.zeros(size)


# ---- epochs -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class EpochSettings:
    """One gradient over all rows per epoch, applied by Adam with decoupled decay; the rate rises over the first share of
    the epochs and then falls to zero."""

    epochs: int = 10
    learning_rate: float = 0.5
    weight_decay: float = 0.01
    warmup_ratio: float = 0.0
    patience: int = PATIENCE
    min_delta: float = MIN_DELTA
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8

    def rate(self, epoch: int) -> float:
        """Learning rate of an epoch, counted from 1."""
        done, rise = epoch - 1, int(self.epochs * self.warmup_ratio)
        share = done / rise if done < rise else (self.epochs - done) / max(1, self.epochs - rise)
        return self.learning_rate * max(0.0, share)


@dataclass
class EpochState:
    """All that the next epoch needs: weights and moments (width, classes), the early stop's best loss and counter."""

    epoch: int
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    best: float = math.inf
    waited: int = 0
    metrics: dict[str, float] = field(default_factory=dict)

    def stopped(self, s: EpochSettings) -> bool:
        return self.waited >= s.patience


def _chances(row: np.ndarray, places: np.ndarray, values: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Softmax probabilities (n, classes)."""
    scores = np.column_stack([np.bincount(row, values * weights[places, c], n) for c in range(weights.shape[1])])
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def epoch_pass(rows: DataFrame, weights: np.ndarray, gradient: bool) -> tuple[dict[str, float], np.ndarray]:
    """(loss, accuracy, f1, precision, recall over the rows; mean gradient). Class 1 is the positive one; ties go to the first class."""
    width, classes = weights.shape
    spread = rows.sparkSession.sparkContext.broadcast(weights)
    counters = 6

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        label, row, places, values = _sparse(batch)
        n, y = len(label), label.astype(np.int64)
        p = _chances(row, places, values, n, spread.value)
        guess = p.argmax(axis=1)
        loss = -np.log(np.maximum(p[np.arange(n), y], 1e-15)).sum()
        counts = [n, loss, (guess == y).sum(), ((guess == 1) & (y == 1)).sum(), ((guess == 1) & (y == 0)).sum(), ((guess == 0) & (y == 1)).sum()]
        if not gradient:
            return np.array(counts, dtype=np.float64)
        p[np.arange(n), y] -= 1
        sums = [np.bincount(places, values * p[row, c], width) for c in range(classes)]
        return np.concatenate([counts, np.column_stack(sums).ravel()])

    total = added_up(rows, of_batch, counters + (width * classes if gradient else 0))
    n, loss, right, tp, fp, fn = total[:counters]
    rows_ = max(n, 1.0)
    precision, recall = tp / (tp + fp + EPSILON), tp / (tp + fn + EPSILON)
    f1 = 2 * precision * recall / (precision + recall + EPSILON)
    found = {"loss": loss / rows_, "accuracy": right / rows_, "f1": f1, "precision": precision, "recall": recall}
    return {k: float(v) for k, v in found.items()}, total[counters:].reshape(width, classes) / rows_ if gradient else np.zeros((0, classes))


_STATE = (
    "train_loss double, val_loss double, val_accuracy double, val_f1 double, val_precision double, val_recall double,"
    " seconds double, best double, waited int, weights binary, first binary, second binary"
)


def _store(spark: SparkSession, path: str, state: EpochState) -> None:
    m = state.metrics
    row = (
        m["train_loss"], m["loss"], m["accuracy"], m["f1"], m["precision"], m["recall"], m["seconds"],
        state.best, state.waited, state.weights.tobytes(), state.first.tobytes(), state.second.tobytes(),
    )
    spark.createDataFrame([row], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={state.epoch}")


def stored_epochs(spark: SparkSession, path: str) -> DataFrame | None:
    """The epochs that a run has stored, with their states; None before the first."""
    try:
        return spark.read.parquet(path).withColumn("epoch", F.col("epoch").cast("int"))
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


METRICS = ["epoch", "train_loss", "val_loss", "val_accuracy", "val_f1", "val_precision", "val_recall", "seconds"]


def epoch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row of metrics per epoch of a run."""
    return stored_epochs(spark, path).select(*METRICS)


def _weights_of(row, name: str, classes: int) -> np.ndarray:
    return np.frombuffer(row[name], dtype=np.float64).reshape(-1, classes).copy()


def best_epoch(spark: SparkSession, path: str) -> int | None:
    """First epoch of the lowest validation loss; a loss of zero or NaN counts as not measured. None without such an epoch."""
    usable = (F.col("val_loss") != 0) & ~F.isnan("val_loss")
    found = stored_epochs(spark, path).where(usable).agg(F.min(F.struct("val_loss", "epoch")).alias("b")).first()
    return None if found.b is None else found.b.epoch


def epoch_weights(spark: SparkSession, path: str, epoch: int, classes: int) -> np.ndarray:
    return _weights_of(stored_epochs(spark, path).where(F.col("epoch") == epoch).select("weights").first(), "weights", classes)


def fit_epochs(train: DataFrame, val: DataFrame, width: int, path: str, settings: EpochSettings = EpochSettings(), classes: int = 2) -> np.ndarray:  # noqa: B008
    """Weights (width, classes) of the best epoch.

    `train` and `val` are feature rows. Every epoch is stored below `path` with its metrics, weights and
    moments before the next one starts; a run that was broken off goes on after its last stored epoch and
    ends with the same numbers. Training stops after `patience` epochs whose validation loss is not more than
    `min_delta` below the best one, and the first epoch of the lowest loss is chosen. An empty train table
    leaves the weights at zero.
    """
    spark = train.sparkSession
    state = EpochState(0, *(np.zeros((width, classes)) for _ in range(3)))
    known = stored_epochs(spark, path)
    if known is not None:
        last = known.orderBy(F.desc("epoch")).first()
        state = EpochState(last.epoch, *(_weights_of(last, c, classes) for c in ("weights", "first", "second")), best=last.best, waited=last.waited)
    s = settings
    while state.epoch < s.epochs and not state.stopped(s):
        began = time.time()
        seen, g = epoch_pass(train, state.weights, gradient=True)
        t, rate = state.epoch + 1, s.rate(state.epoch + 1)
        first = s.beta1 * state.first + (1 - s.beta1) * g
        second = s.beta2 * state.second + (1 - s.beta2) * g * g
        step = (first / (1 - s.beta1**t)) / (np.sqrt(second / (1 - s.beta2**t)) + s.eps)
        weights = state.weights * (1 - rate * s.weight_decay) - rate * step
        judged, _ = epoch_pass(val, weights, gradient=False)
        better = judged["loss"] < state.best - s.min_delta
        metrics = judged | {"train_loss": seen["loss"], "seconds": time.time() - began}
        state = EpochState(t, weights, first, second, judged["loss"] if better else state.best, 0 if better else state.waited + 1, metrics)
        _store(spark, path, state)
    chosen = best_epoch(spark, path) if s.epochs else None
    return epoch_weights(spark, path, chosen, classes) if chosen is not None else state.weights


# ---- stored models ------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinearTextModel:
    """Classes of texts by a linear model over `TextFeatures`."""

    features: TextFeatures
    weights: np.ndarray

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(class, its probability) of each text."""
        if not len(texts):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        places, values, first = self.features(texts)
        p = _chances(np.repeat(np.arange(len(texts)), np.diff(first)), places, values, len(texts), self.weights)
        return p.argmax(axis=1), p.max(axis=1)

    def save(self, spark: SparkSession, path: str, **notes: float) -> None:
        """Write the model; a repeated save replaces it."""
        row = [(self.features.words, self.weights.shape[1], self.weights.tobytes(), {k: float(v) for k, v in notes.items()})]
        spark.createDataFrame(row, "words int, classes int, weights binary, notes map<string,double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearTextModel:
        row = spark.read.parquet(path).first()
        return LinearTextModel(TextFeatures(row.words), _weights_of(row, "weights", row.classes))


# ---- exact least squares ------------------------------------------------------------------------


def least_squares(rows: DataFrame, width: int, ridge: float = 0.0) -> np.ndarray:
    """Coefficients of least squared error over feature rows, exact up to rounding.

    One pass adds up the Gram matrix and the cross products; a Cholesky factor of `width` columns solves
    them on the driver. Columns that others determine get the solution of least norm. `width` is bounded.
    """
    if width > MAX_WIDTH:
        raise ValueError(f"at most {MAX_WIDTH} columns: the matrix is kept whole")

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        label, row, places, values = _sparse(batch)
        total = np.zeros((width, width + 1))
        for a in range(0, len(label), 1024):  # dense rows of a bounded block
            own = slice(*np.searchsorted(row, [a, a + 1024]))
            block = np.zeros((min(1024, len(label) - a), width))
            np.add.at(block, (row[own] - a, places[own]), values[own])
            total[:, :width] += block.T @ block
            total[:, width] += block.T @ label[a : a + 1024]
        return total.ravel()

    total = added_up(rows, of_batch, width * (width + 1)).reshape(width, width + 1)
    gram, cross = total[:, :width] + ridge * np.eye(width), total[:, width]
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))  # columns of very different size
    even = gram / scale[:, None] / scale[None, :]
    try:
        factor = np.linalg.cholesky(even)
        if np.diag(factor).min() < 1e-7:
            raise np.linalg.LinAlgError
        half = np.linalg.solve(factor, cross / scale)
        return np.linalg.solve(factor.T, half) / scale
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(even, cross / scale, rcond=1e-12)[0] / scale


def numeric_rows(df: DataFrame, columns: list[str], label: str, intercept: bool = True) -> DataFrame:
    """Feature rows of numeric columns, after an intercept; rows with a missing value are left out, as SQL's aggregates do."""
    values = [F.lit(1.0)] * intercept + [F.col(c).cast("double") for c in columns]
    usable: Column = F.col(label).isNotNull()
    for c in columns:
        usable = usable & F.col(c).isNotNull()
    return df.where(usable).select(
        F.col(label).cast("double").alias("label"), F.array(*[F.lit(i) for i in range(len(values))]).alias("places"), F.array(*values).alias("values")
    )


def regression_errors(rows: DataFrame, coefficients: np.ndarray) -> DataFrame:
    """Mean squared error and its root over feature rows."""
    weights = F.array(*[F.lit(float(x)) for x in coefficients])
    guess = F.aggregate(F.zip_with("places", "values", lambda p, v: F.element_at(weights, p + 1) * v), F.lit(0.0), lambda s, x: s + x)
    return rows.agg(F.avg((guess - F.col("label")) ** 2).alias("mse")).select("mse", F.sqrt("mse").alias("rmse"))


def settings_of(params: dict) -> EpochSettings:
    return EpochSettings(**{k: v for k, v in params.items() if k in asdict(EpochSettings())})
