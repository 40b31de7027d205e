"""Source to raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.sinks import land_jsonl
from sluiceway.sources.files import scan_batch
from sluiceway.sources.paged_api import api_records, scan_pages
from sluiceway.streaming.ingest import land_messages


def ingest_files(spark: SparkSession, source: str, raw_path: str) -> int:
    """Land all Parquet and CSV rows below a path; returns their number."""
    return land_jsonl(scan_batch(spark, source), raw_path)


def ingest_api(spark: SparkSession, url: str, raw_path: str, **options) -> int:
    """Land the items of a paged interface; returns their number."""
    return land_jsonl(api_records(scan_pages(spark, url, **options), url), raw_path)


def ingest_messages(messages: DataFrame, raw_path: str, checkpoint: str, failfast: bool = False) -> None:
    """Land the messages that are there now."""
    land_messages(messages, raw_path, checkpoint, failfast).awaitTermination()
