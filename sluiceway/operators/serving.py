"""Answers to prediction requests, one row per request, in the order of its inputs."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluiceway.operators.linear import LinearTextModel
from sluiceway.operators.requests import MAX_INPUTS, check_predict_requests

ANSWER = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("predictions", T.ArrayType(T.IntegerType())),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
        T.StructField("detail", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
    ]
)


def answer_requests(requests: DataFrame, models: dict[str, LinearTextModel], inputs: str = "inputs") -> DataFrame:
    """The requests' columns but the inputs, `model_version`, and ANSWER.

    A request is a row, so its inputs stay together and in order without a shuffle or a group; its size is
    bounded by the rule of at most `MAX_INPUTS` inputs. A task receives the models once (by broadcast; their
    size is their own), and the inputs of all good requests of a batch are predicted together. A request
    that breaks a rule, or asks for a version that isn't there, has status `error`, a detail and no
    predictions; it doesn't touch its neighbours. `latency_ms` is the request's share of its batch's time.
    An empty text is an input like any other; a missing one breaks the rule.
    """
    checked = check_predict_requests(requests, inputs)
    count = F.coalesce(F.size(F.col(inputs)), F.lit(0))
    problem = (
        F.when(count < 1, "no inputs")
        .when(count > MAX_INPUTS, F.concat(F.lit("more than "), F.lit(MAX_INPUTS).cast("string"), F.lit(" inputs")))
        .when(~F.col("valid"), "an input is missing")
        .when(~F.col("model_version").isin(list(models)), F.concat(F.lit("no model version "), F.col("model_version")))
    )
    others = [c for c in requests.columns if c not in (inputs, "model_version")]
    shaped = checked.select(*[F.col(f"`{c}`") for c in others], "model_version", F.when(problem.isNull(), F.col(inputs)).alias("_inputs"), problem.alias("_problem"))
    spread = requests.sparkSession.sparkContext.broadcast(models)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            began = time.perf_counter()
            texts, version = batch["_inputs"], batch["model_version"].to_pylist()
            first = texts.offsets.to_numpy().astype(np.int64)
            first, flat = first - first[0], texts.flatten().cast(pa.large_string())
            size = np.diff(first)
            of = np.repeat(np.array([list(spread.value).index(v) if v in spread.value else -1 for v in version], dtype=np.int64), size)
            guess, chance = np.zeros(len(flat), dtype=np.int64), np.zeros(len(flat))
            for k, model in enumerate(spread.value.values()):
                own = np.flatnonzero(of == k)
                if len(own):
                    guess[own], chance[own] = model(flat.take(pa.array(own)))
            bad = np.array([p is not None for p in batch["_problem"].to_pylist()], dtype=bool)
            border, missing = pa.array(first.astype(np.int32)), pa.array(bad)
            lists = [pa.ListArray.from_arrays(border, pa.array(x), mask=missing) for x in (guess.astype(np.int32), chance)]
            spent = (time.perf_counter() - began) * 1000
            share = spent * size / size.sum() if size.sum() else np.zeros(len(size))
            status = pa.array(np.where(bad, "error", "ok").tolist(), pa.string())
            plain = [batch[c] for c in [*others, "model_version"]]
            yield pa.record_batch([*plain, status, *lists, batch["_problem"], pa.array(share)], names)

    names = [*others, "model_version", *ANSWER.names]
    schema = T.StructType([*shaped.select(*[F.col(f"`{c}`") for c in others], "model_version").schema.fields, *ANSWER.fields])
    return shaped.mapInArrow(answered, schema)
