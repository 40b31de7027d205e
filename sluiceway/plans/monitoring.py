"""Current data to drift report, retraining decision and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluiceway.operators.drift import check_drift, retrain_decision
from sluiceway.operators.service_metrics import check_alerts, service_snapshot
from sluiceway.operators.sinks import append_retrain_trigger, save_report
from sluiceway.session import to_scratch_table
from sluiceway.sources.files import feedback_count


def run_monitoring(
    reference: DataFrame,
    current: DataFrame,
    feedback_path: str,
    log: DataFrame | None = None,
    reports_path: str | None = None,
    triggers_path: str | None = None,
    method: str = "tests",
) -> dict[str, DataFrame]:
    """report, decision and (with a request log) snapshot with alerts, each a small table."""
    spark = reference.sparkSession
    # A one-row table, kept so that saving it and deciding on it do not compute it twice.
    report = to_scratch_table(check_drift(reference, current, method), "report")
    decision = retrain_decision(report, feedback_count(spark, feedback_path).scalar())
    if reports_path:
        save_report(report, reports_path)
    if triggers_path:
        append_retrain_trigger(decision, triggers_path)
    found = {"report": report, "decision": decision}
    if log is not None:
        found["snapshot"] = check_alerts(service_snapshot(log))
    return found


def alert_rows(snapshot: DataFrame) -> DataFrame:
    """One row per alert message."""
    return snapshot.select(F.explode("alerts").alias("alert"))
