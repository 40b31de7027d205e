"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Runs of one to three characters (lower-cased by Python's rules, digits as 0) are hashed into 2^15 places.
A place's value is (1 + log count) * idf, scaled to unit length; idf comes from the document frequencies of
all rows that may be learned from: those where `learn` holds and that have a text and a language. No other
row's text has any effect on the model. The weights are trained with FTRL, whose L1 and L2 terms are the
elastic net, on a bounded sample of these rows (`max_rows`, by the hash of id and text): every language gets
an equal share of it, and what rare languages leave goes to the others. A tenth of the sample is kept from
training to choose the temperature that divides all scores so that probabilities are calibrated; a weak pull
towards 1 keeps it finite where the kept rows are told apart without an error.

Null texts and texts without a letter are `und` with score 1; with no languages to learn every text is.
Repeated rows count once in training. Ties go to the language first in order. An empty table gives no rows.
Other columns than doc_id, text and lang are not read, whatever their names. Texts are taken whole; a task
holds several 8-byte numbers per character of the text at hand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm import ftrl, textscan

BITS = 15
MAX_ROWS = 16_000
UNDETERMINED = "und"
SETTINGS = ftrl.Settings(alpha=0.5, l1=0.02, l2=0.1, epochs=2)
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of the text's character n-grams."""
    chars = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    chars = np.where((chars >= 48) & (chars <= 57), np.uint64(48), chars) + np.uint64(1)
    shift = np.uint64(64 - BITS)
    counts = np.zeros(1 << BITS, dtype=np.int64)
    gram = chars
    for k in range(3):
        if k:
            gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + chars[k:]
        spread = gram * np.uint64(0xD6E8FEB86659FD93)
        spread = (spread ^ (spread >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        counts += np.bincount((spread >> shift).astype(np.int64), minlength=1 << BITS)
    places = np.flatnonzero(counts)
    return places, counts[places]


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each place over the given documents; each task sends one counter per place."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                total += 1
                seen[gram_counts(text or "")[0]] += 1
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(seen[at], total), pa.int64())], ["place", "n"])

    rows = docs.select("text").mapInArrow(textscan.freeing(counted), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {r.place: r.n for r in rows}
    total = found.pop(-1, 0)
    idf = np.full(1 << BITS, np.log(1.0 + total), dtype=np.float32)
    for place, n in found.items():
        idf[place] = np.log((1.0 + total) / (1.0 + n)) + 0.05
    return idf


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places, counts = gram_counts(text)
    values = (1 + np.log(counts)) * idf[places]
    norm = np.sqrt((values * values).sum())
    return places.astype(np.int32), (values / norm if norm else values).astype(np.float32)


def train(docs: DataFrame, learn: Column, max_rows: int = MAX_ROWS, settings: ftrl.Settings = SETTINGS) -> Model:
    """Model of the languages in the rows where `learn` holds; the driver holds its weights and the calibration scores."""
    rows = docs.where(learn).select("text", F.col("lang").alias("label"), F.xxhash64("doc_id", "text").alias("key"))
    rows = rows.where(F.col("label").isNotNull() & (F.col("label") != UNDETERMINED) & F.col("text").isNotNull())
    idf = inverse_frequencies(rows)
    found = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    languages = sorted(found)
    n = sum(found.values())
    if n > max_rows:
        shares = sample_shares(found, max_rows)
        share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("label"))
        rows = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * (1 << 30))
    if len(languages) < 2:
        return Model(languages, np.zeros((1 << BITS, max(1, len(languages))), dtype=np.float32), idf, 1.0)
    number = {name: i for i, name in enumerate(languages)}

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label, key in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), batch["key"].to_pylist(), strict=True):
                if _LETTER.search(text):
                    places, values = features(text, idf)
                    out.append((key, number[label], places.tobytes(), values.tobytes()))
            key, label, places, values = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.record_batch([pa.array(key, pa.int64()), pa.array(label, pa.int32()), pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["key", "label", "places", "values"])

    sample = rows.mapInArrow(textscan.freeing(made), "key long, label int, places binary, values binary").dropDuplicates(["key"])
    sample = sample.withColumn("shard", F.pmod(F.shiftright("key", 8), F.lit(settings.shards(min(n, max_rows)))).cast("int"))
    kept = F.pmod("key", F.lit(10)) == 0
    weights = ftrl.fit(sample.where(~kept), 1 << BITS, len(languages), settings)
    if weights.shape[1] == 1:  # two languages share one column
        weights = np.hstack([-weights / 2, weights / 2])
    spread = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [
                (np.frombuffer(v, dtype=np.float32) @ spread.value[np.frombuffer(p, dtype=np.int32)]).astype(np.float64).tolist()
                for p, v in zip(batch["places"].to_pylist(), batch["values"].to_pylist(), strict=True)
            ]
            yield pa.record_batch([batch["label"], pa.array(raw, pa.list_(pa.float64()))], ["label", "raw"])

    held = sample.where(kept).select("places", "values", "label").mapInArrow(scored, "label int, raw array<double>").collect()
    return Model(languages, weights, idf, best_temperature(np.array([r.raw for r in held]), np.array([r.label for r in held])))


def sample_shares(counts: dict[str, int], max_rows: int) -> dict[str, float]:
    """Share of each language's rows to take: equal numbers of rows, what small languages lack goes to the others."""
    shares, left, room = {}, len(counts), float(max_rows)
    for label, n in sorted(counts.items(), key=lambda x: (x[1], x[0])):
        take = min(float(n), room / left)
        shares[label] = take / n
        room, left = room - take, left - 1
    return shares


# Weight of the pull of the temperature towards 1, in rows.
PULL = 0.5


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the scores with the least log loss plus pull, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = ftrl.probabilities(scores / np.exp(log_t))
        fit = float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())
        return fit + PULL * log_t * log_t / len(labels)

    low, high, ratio = np.log(1e-4), np.log(1e4), (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def identify(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for text in texts:
        if not text or not model.languages or not _LETTER.search(text):
            names.append(UNDETERMINED)
            scores.append(1.0)
            continue
        places, values = features(text, model.idf)
        p = ftrl.probabilities((values @ model.weights[places]) / model.temperature)
        names.append(model.languages[int(p.argmax())])
        scores.append(float(p.max()))
    return names, scores


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text, without a shuffle. Places and languages fix the model's size."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = identify(batch["text"].to_pylist(), spread.value)
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    return rows.mapInArrow(textscan.freeing(predicted), SCHEMA)


MIN_SCORE = 0.5


def accepted(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, with all their columns, whose language is determined with at least `min_score`."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in textscan.parts(whole)):
            names, scores = identify(batch["text"].to_pylist(), spread.value)
            keep = [name != UNDETERMINED and p >= min_score for name, p in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(textscan.freeing(kept), docs.schema)
