"""Sinks: raw zone, splits, reports, feedback, retrain triggers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from sluiceway.operators.clean import flatten_payload


def land_jsonl(records: DataFrame, path: str) -> int:
    """Append records to the raw zone as JSON lines; returns their number, counted while writing."""
    seen = Observation()
    records.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").json(path)
    return seen.get["rows"]


def materialise(df: DataFrame, path: str, split: str = "train") -> str:
    """Flatten the payload and write one split, replacing the last one. Returns its path."""
    out = f"{path}/{split}"
    flatten_payload(df).write.mode("overwrite").parquet(out)
    return out


def save_report(report: DataFrame, path: str) -> None:
    """Append a drift report, in a folder named by its time."""
    run = F.date_format("timestamp", "yyyyMMdd'T'HHmmss")
    report.withColumn("run", run).write.mode("append").partitionBy("run").json(path)


def append_feedback(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def append_retrain_trigger(decision: DataFrame, path: str) -> None:
    """Append time and reason if the decision is to retrain."""
    decision.where("should_retrain").select(F.current_timestamp().alias("timestamp"), "reason").write.mode("append").json(path)
