"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL.

Tokens are runs of letters and digits (with all characters beyond ASCII) and runs of other visible ASCII
characters; words of several capitals also count as a shape. Single tokens and neighbouring pairs are hashed
into 2^18 places with value 1 + log(count), scaled to unit length. A score is the sparse dot product with the
weights, through the logistic function; the bias is a place of its own, so an empty text has a score too.

The model learns from a bounded sample of labelled rows (`max_rows`, by the hash of their id); everything
else covers all rows. Null texts are empty. Documents with several labels give a row for each. Without any
training rows all weights are zero and scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm import blocks, ftrl, textscan

BITS = 18
MAX_ROWS = 24_000
THRESHOLD = 0.7
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
_SHOUT = np.uint64(0x2545F4914F6CDD1D)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text of a slice."""
    starts, ends = textscan.runs(_KIND[data], offsets)
    hashes = textscan.span_hashes(textscan.lowered(data), starts, ends)
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[data])])
    shouted = (capitals[ends] - capitals[starts] == ends - starts) & (ends - starts > 1)
    pairs = textscan.mix(hashes[:-1] * np.uint64(0x9FB21C651E98DF25) + hashes[1:])
    shift = np.uint64(64 - bits)
    single, pair = (hashes >> shift).astype(np.int32), (pairs >> shift).astype(np.int32)
    shape = np.int32(int(_SHOUT) >> (64 - bits))
    first = np.searchsorted(starts, offsets)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        shouts = int(shouted[a:b].sum())
        every = np.concatenate([single[a:b], pair[a : max(a, b - 1)], np.full(shouts, shape, dtype=np.int32)])
        places, counts = np.unique(every, return_counts=True)
        values = 1 + np.log(counts)
        # The bias keeps its own place beyond the hashed ones.
        if len(values):
            values = values / np.sqrt((values * values).sum())
        yield np.append(places, np.int32(1 << bits)).astype(np.int32), np.append(values, 1.0).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_rows: int = MAX_ROWS, settings: ftrl.Settings = ftrl.Settings()) -> np.ndarray:  # noqa: B008
    """Weights from labelled documents for which `learn` (of doc_id) holds."""
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("label_id").isNotNull() & F.col("label").isin(0, 1)).withColumn("doc_id", F.col("label_id")).where(learn).drop("doc_id").distinct()
    n = usable.count()
    place = F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(1 << 30))
    if n > max_rows:
        usable = usable.where(place < int((1 << 30) * max_rows / n))
    # The sample is at most about `max_rows` pairs of numbers: that is what is broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(usable), F.col("doc_id") == F.col("label_id"))
    rows = rows.select("text", "label", F.xxhash64("doc_id", F.lit(2)).alias("key"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in textscan.slices(batch["text"]):
                found = [(p.tobytes(), v.tobytes()) for p, v in features(data, offsets)]
                places, values = zip(*found, strict=True)
                yield pa.record_batch(
                    [batch["key"].slice(at, len(found)), batch["label"].slice(at, len(found)), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
                    ["key", "label", "places", "values"],
                )

    sample = rows.mapInArrow(made, "key long, label int, places binary, values binary")
    sample = sample.dropDuplicates(["key", "label"]).withColumn("shard", F.pmod("key", F.lit(settings.shards(min(n, max_rows)))).cast("int"))
    return ftrl.fit(sample, (1 << BITS) + 1, 2, settings)[:, 0]


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, weights: np.ndarray, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text, without a shuffle. The model's size is fixed."""
    spread = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = spread.value
        for batch in batches:
            for at, data, offsets in textscan.slices(batch["text"]):
                raw = np.array([float(w[p] @ v) for p, v in features(data, offsets)])
                p = 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35)))
                n = len(p)
                columns = [batch["doc_id"].slice(at, n), batch["held_out"].slice(at, n), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
                yield pa.record_batch(columns, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(scored, SCHEMA)


def held_out_rule(doc_id: str = "doc_id") -> Column:
    return blocks.crc_mod(F.col(doc_id), 4) == 2
