"""Follow-the-regularised-leader training of sparse linear classifiers, in parallel shards that are averaged.

Each shard runs FTRL-proximal over its rows in a fixed order, with one row of weights per class; the shards'
weights are averaged. A shard is one group of a bounded sample, so its size doesn't follow the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.1
    epochs: int = 3
    shard_rows: int = 3_000

    def shards(self, rows: int) -> int:
        return max(1, round(rows / self.shard_rows))


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax over the last axis."""
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, classes: int, s: Settings) -> np.ndarray:
    """Weights (size, classes) after all epochs over (places, values, class) rows; two classes use one column."""
    width = 1 if classes == 2 else classes
    z = np.zeros((size, width))
    n = np.zeros((size, width))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        w = (np.sign(zs) * s.l1 - zs) / ((s.beta + np.sqrt(ns)) / s.alpha + s.l2)
        return np.where(np.abs(zs) <= s.l1, 0.0, w)

    target = np.eye(classes)
    for _ in range(s.epochs):
        for places, values, label in rows:
            zs, ns = z[places], n[places]
            w = weights(zs, ns)
            score = values @ w
            if width == 1:
                error = 1.0 / (1.0 + np.exp(-np.clip(score, -35, 35))) - label
            else:
                error = probabilities(score) - target[label]
            g = values[:, None] * error[None, :]
            total = ns + g * g
            z[places] = zs + g - (np.sqrt(total) - np.sqrt(ns)) / s.alpha * w
            n[places] = total
    return weights(z, n)


def fit(sample: DataFrame, size: int, classes: int, settings: Settings) -> np.ndarray:
    """Mean of the shards' weights. `sample`: shard int, key long, label int, places binary (int32), values binary (float32)."""

    def trained(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        rows = [
            (np.frombuffer(p, dtype=np.int32), np.frombuffer(v, dtype=np.float32).astype(np.float64), y)
            for p, v, y in zip(table["places"].to_pylist(), table["values"].to_pylist(), table["label"].to_pylist(), strict=True)
        ]
        w = fit_rows(rows, size, classes, settings).astype(np.float32)
        return pa.table({"rows": pa.array([len(rows)], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})

    width = 1 if classes == 2 else classes
    found = sample.groupBy("shard").applyInArrow(trained, "rows long, w binary").collect()
    if not found:
        return np.zeros((size, width), dtype=np.float32)
    rows = sum(r.rows for r in found)
    return sum(np.frombuffer(r.w, dtype=np.float32).reshape(size, width) * (r.rows / rows) for r in found).astype(np.float32)
