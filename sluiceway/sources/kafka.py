"""Messages of a topic in the raw envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions.clock import message_source
from sluiceway.sources.envelope import envelope


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """Streaming messages of a topic. The checkpoint of the query keeps the position in it."""
    return _kafka(spark.readStream, servers, topic, starting, options).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """The messages that a topic holds now."""
    return _kafka(spark.read, servers, topic, starting, options).load()


def _kafka(reader, servers: str, topic: str, starting: str, options: dict):
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )


def message_records(messages: DataFrame, failfast: bool = False) -> DataFrame:
    """Envelopes plus `status`: "ok", or "quarantine" for a value that is no JSON object.

    Works on any batch or streaming table in the layout of Kafka's source. With `failfast` a bad
    message ends the job instead. The source text is unique per message and so the key by which a
    re-read can be recognised.
    """
    text = F.col("value").cast("string")
    parsed = F.parse_json(text) if failfast else F.try_parse_json(text)
    good = F.coalesce(parsed.isNotNull() & text.rlike(r"^\s*\{"), F.lit(False))
    status = F.when(good, "ok").otherwise("quarantine")
    judged = messages.select("*", text.alias("_text"), status.alias("status"))
    rows = envelope(
        judged.withColumn("_keep", F.col("status")),
        F.lit(None),
        message_source(F.col("topic"), F.col("partition"), F.col("offset")),
        F.struct("_text", "_keep"),
        F.col("timestamp").cast("timestamp"),
    )
    return rows.select(
        "id", "source", "timestamp", F.col("payload._text").alias("payload"), "schema_version", F.col("payload._keep").alias("status")
    )
