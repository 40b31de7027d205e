"""Landing message and feedback streams in the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.requests import feedback_records
from sluiceway.sources.kafka import message_records


def land_messages(messages: DataFrame, path: str, checkpoint: str, failfast: bool = False) -> StreamingQuery:
    """Land the messages that are there now as JSON lines below status=ok and status=quarantine.

    One pass over the topic; file sink and checkpoint together write each message exactly once, also
    when the query is started again after a failure.
    """
    return (
        message_records(messages, failfast)
        .writeStream.format("json")
        .partitionBy("status")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_feedback(bodies: DataFrame, path: str, checkpoint: str, body: str = "body") -> StreamingQuery:
    """Append feedback rows from a stream of JSON bodies."""
    return (
        feedback_records(bodies, body)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
