"""Running counters and rolling latency state over request streams.

A state is a small table that each micro-batch replaces. Two versions are kept in turn, so what is stored
doesn't grow with the number of batches, and a batch that is repeated after a failure starts from the same
version as before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.ranking import first_per_group
from sluiceway.operators.service_metrics import WINDOW, window_figures, status_counts


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of both versions with their `batch` and `slot`; none before the first batch."""
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("slot", T.IntegerType())])
    try:
        return spark.read.schema(stored).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)


def _replace_by_batch(
    stream: DataFrame, path: str, checkpoint: str, mode: str, merged: Callable[[DataFrame, DataFrame], DataFrame]
) -> StreamingQuery:
    """After each micro-batch the state is `merged(batch, state before)`."""

    def save(batch: DataFrame, batch_id: int) -> None:
        versions = _versions(batch.sparkSession, path, batch.schema).where(F.col("batch") < batch_id)
        last = versions.agg(F.max(F.struct("batch", "slot")).alias("v")).first().v
        held = versions.where(F.col("batch") == last.batch if last else F.lit(False)).drop("batch", "slot")
        slot = 1 - last.slot if last else 0
        merged(batch, held).withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/slot={slot}")

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _newest(spark: SparkSession, path: str) -> DataFrame:
    written = spark.read.parquet(path)
    return written.where(F.col("batch") == written.agg(F.max("batch")).scalar()).drop("batch", "slot")


def count_statuses(log: DataFrame, path: str, checkpoint: str, status: str = "status") -> StreamingQuery:
    """Requests per status since the start of the stream; every batch writes the totals so far."""
    return _replace_by_batch(status_counts(log, status), path, checkpoint, "complete", lambda totals, before: totals)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    return _newest(spark, path)


def keep_last_rows(log: DataFrame, path: str, checkpoint: str, window: int = WINDOW) -> StreamingQuery:
    """Keep the last `window` latencies per service in (ts, seq) order; `log` has service, ts, seq, latency_ms.

    A batch joins the rows held so far under a rank limit that Spark applies in each task before its
    shuffle, so a hot service sends at most `window` rows per task.
    """
    rows = log.where("latency_ms is not null").select(
        "service",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("seq").cast("bigint").alias("seq"),
        F.col("latency_ms").cast("double").alias("latency"),
    )

    def merged(batch: DataFrame, held: DataFrame) -> DataFrame:
        return first_per_group(batch.unionByName(held), "service", [F.desc("ts"), F.desc("seq")], window)

    return _replace_by_batch(rows, path, checkpoint, "append", merged)


def rolling_snapshot(spark: SparkSession, path: str, window: int = WINDOW) -> DataFrame:
    """service, mean and percentiles over its last `window` rows of those held."""
    return (
        first_per_group(_newest(spark, path), "service", [F.desc("ts"), F.desc("seq")], window)
        .groupBy("service")
        .agg(F.collect_list("latency").alias("held"))
        .select("service", *window_figures(F.col("held")))
    )
