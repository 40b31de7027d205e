"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_of(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def month_of(ts: Column) -> Column:
    return F.month(ts)


def from_epoch_ms(ms: Column) -> Column:
    """UTC timestamp of an epoch in milliseconds."""
    return F.timestamp_millis(ms)


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds from start to end, for zoned and zone-less timestamps."""
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def message_source(topic: Column, partition: Column, offset: Column) -> Column:
    """Where a message came from; also its idempotence key."""
    return F.concat_ws(":", F.lit("kafka"), topic, partition.cast("string"), offset.cast("string"))
