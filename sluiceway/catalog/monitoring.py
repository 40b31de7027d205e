"""Drift, retraining, service metrics, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluiceway.catalog.base import MEASURES, before_and_after, request_log, rounded, table
from sluiceway.operators.drift import chi2_tests, drift_report, ks_tests, psi_bins, psi_scores, retrain_decision
from sluiceway.operators.reference_profile import merge_profiles, store_profile
from sluiceway.operators.service_metrics import (
    PERCENTILES,
    check_alerts,
    latency_histogram,
    rolling_latency,
    service_snapshot,
    status_counts,
)
from sluiceway.operators.sinks import append_retrain_trigger, save_report
from sluiceway.plans.monitoring import alert_rows
from sluiceway.schemas import RAW_RECORD
from sluiceway.session import scratch_path, to_scratch_table
from sluiceway.streaming.counters import count_statuses, keep_last_rows, latest_counts, rolling_snapshot
from sluiceway.streaming.ingest import land_feedback, land_messages

ROLLING = 100
FIGURES = ["mean_ms", *[f"p{p}_ms" for p in PERCENTILES]]


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return before_and_after(table(spark, sf_dir, "lineitem").select("l_shipdate", *MEASURES), "l_shipdate")


def psi_bin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return psi_bins(*_lines(spark, sf_dir), MEASURES).select("column", "bin", "n_ref", "n_cur")


def psi_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return psi_scores(*_lines(spark, sf_dir), MEASURES).select("column", rounded("psi"), "status")


def psi_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    # At the default limit nothing drifts in these tables; a low one exercises the list.
    report = drift_report(psi_scores(*_lines(spark, sf_dir), MEASURES), threshold=0.0001)
    return report.select("dataset_drift", rounded("drift_score"), F.array_join("drifted_columns", ",").alias("drifted"))


def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = ks_tests(*_lines(spark, sf_dir), MEASURES)
    return tests.select("column", rounded("statistic"), rounded("p_value"), "drift_detected")


def chi2_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus", "o_orderpriority")
    tests = chi2_tests(*before_and_after(orders, "o_orderdate"))
    return tests.select("column", rounded("statistic"), rounded("p_value"), "drift_detected")


def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the reference lines profiled apart and merged; the current lines against the stored profile."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_linenumber", *MEASURES, "l_returnflag")
    reference, current = before_and_after(lines, "l_shipdate")
    base = scratch_path(spark, "profiles")
    parts = [store_profile(reference.where(half), f"{base}/{i}", [*MEASURES, "l_returnflag"]) for i, half in enumerate(("l_linenumber <= 2", "l_linenumber > 2"))]
    profile = merge_profiles(parts, f"{base}/all")
    scores = profile.psi_scores(current).select("column", F.lit("psi").alias("test"), F.col("psi").alias("statistic"))
    tests = profile.tests(current).select("column", "test", "statistic")
    return scores.unionByName(tests).select("column", "test", rounded("statistic"))


def retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels stand for the feedback collected."""
    report = drift_report(psi_scores(*_lines(spark, sf_dir), MEASURES))
    return retrain_decision(report, table(spark, sf_dir, "labels").agg(F.count(F.lit(1))).scalar(), min_feedback=300)


def saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift report, appended to the reports and read back."""
    path = scratch_path(spark, "reports")
    save_report(drift_report(psi_scores(*_lines(spark, sf_dir), MEASURES), threshold=0.0001), path)
    stored = spark.read.schema("dataset_drift boolean, drift_score double, drifted_columns array<string>").json(path)
    return stored.select("dataset_drift", rounded("drift_score"), F.array_join("drifted_columns", ",").alias("drifted"))


def retrain_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triggers recorded for two decisions, of which the second asks for more feedback than there is."""
    path = scratch_path(spark, "triggers")
    report = to_scratch_table(drift_report(psi_scores(*_lines(spark, sf_dir), MEASURES)), "report")
    rows = table(spark, sf_dir, "labels").agg(F.count(F.lit(1)))
    for least in (1, 1 << 60):
        append_retrain_trigger(retrain_decision(report, rows.scalar(), min_feedback=least), path)
    return spark.read.schema("timestamp timestamp, reason string").json(path).select("reason")


def _figures(df: DataFrame, *keys: str) -> DataFrame:
    totals = [c for c in df.columns if c in ("total_requests", "total_errors")]
    rates = [c for c in df.columns if c in ("uptime_seconds", "error_rate", "throughput_rps")]
    return df.select(*keys, *totals, *[rounded(c) for c in rates], *[rounded(c, 9) for c in FIGURES])


def latency_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(service_snapshot(request_log(spark, sf_dir)))


def latency_snapshot_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _figures(service_snapshot(request_log(spark, sf_dir), group="service"), "service")


def latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_rows(check_alerts(service_snapshot(request_log(spark, sf_dir))))


def latency_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = rolling_latency(request_log(spark, sf_dir), "service", window=ROLLING)
    return rolled.select("service", "seq", *[rounded(c, 9) for c in FIGURES])


def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(request_log(spark, sf_dir))


def latency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = request_log(spark, sf_dir)
    found = latency_histogram(log, F.col("latency_ms") / 1000, F.col("status") == "ok")
    return found.select("le", "requests", rounded("seconds_sum", 4), "seconds_count")


# ---- streams: the events file is read as a stream and drained ------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema)
    # A stream reads folders: the table's own, or for a single file the one it lies in.
    if stored.inputFiles()[0].endswith("/events.parquet"):
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the layout of a message source; errors carry a broken value."""
    return _event_stream(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"),
        F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props")).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    land_messages(_message_stream(spark, sf_dir), f"{base}/raw", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(T.StructType([*RAW_RECORD.fields, T.StructField("status", T.StringType())])).json(f"{base}/raw")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _landed(spark, sf_dir).where("status = 'ok'")
    return good.select("source", F.get_json_object("payload", "$.k").cast("bigint").alias("k"), "schema_version")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir).where("status = 'quarantine'").select("source", "payload")


def _stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return _event_stream(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        "ts",
        F.col("event_type").alias("service"),
        F.col("value").alias("latency_ms"),
        F.when(failed, "error").otherwise("ok").alias("status"),
    )


def stream_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    count_statuses(_stream_log(spark, sf_dir), f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return latest_counts(spark, f"{base}/counts")


def stream_rolling_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    keep_last_rows(_stream_log(spark, sf_dir), f"{base}/states", f"{base}/checkpoint", ROLLING).awaitTermination()
    return rolling_snapshot(spark, f"{base}/states", ROLLING).select("service", *[rounded(c, 9) for c in FIGURES])


def stream_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    bodies = _event_stream(spark, sf_dir).select(
        F.to_json(F.struct(F.col("event_id").cast("string").alias("prediction_id"), F.col("event_type").alias("true_label"))).alias("body")
    )
    land_feedback(bodies, f"{base}/feedback", f"{base}/checkpoint").awaitTermination()
    found = spark.read.json(f"{base}/feedback")
    return found.groupBy("true_label", "source").agg(F.count(F.lit(1)).alias("feedback_rows"))


QUERIES = {
    "psi_bin_counts": psi_bin_counts,
    "psi_per_column": psi_per_column,
    "psi_dataset": psi_dataset,
    "ks_drift": ks_drift,
    "chi2_drift": chi2_drift,
    "profile_drift": profile_drift,
    "retrain_decision": retrain,
    "saved_report": saved_report,
    "retrain_trigger": retrain_trigger,
    "latency_snapshot": latency_snapshot,
    "latency_snapshot_by_service": latency_snapshot_by_service,
    "latency_alerts": latency_alerts,
    "latency_rolling": latency_rolling,
    "status_counts": status_totals,
    "latency_histogram": latency_buckets,
    "stream_ingest": stream_ingest,
    "stream_quarantine": stream_quarantine,
    "stream_status_counts": stream_status_counts,
    "stream_rolling_latency": stream_rolling_latency,
    "stream_feedback": stream_feedback,
}

_LONG = """
    long AS (SELECT l_shipdate < TIMESTAMP '1998-06-01' AS is_ref,
                    unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS col,
                    unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v
             FROM lineitem)"""
_PSI = f"""
    {_LONG},
    span AS (SELECT col, min(v) FILTER (WHERE is_ref) AS lo, max(v) FILTER (WHERE is_ref) AS hi,
                    count(*) FILTER (WHERE is_ref) AS ref_rows, count(*) FILTER (WHERE NOT is_ref) AS cur_rows
             FROM long GROUP BY col),
    placed AS (SELECT col, is_ref, 1 + list_sum(list_transform(range(1, 10), lambda i:
                          CASE WHEN v > lo + i * ((hi - lo) / 10) THEN 1 ELSE 0 END)) AS bin
               FROM long JOIN span USING (col)),
    counts AS (SELECT col, bin, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
               FROM placed GROUP BY col, bin),
    grid AS (SELECT col, bin, coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur, ref_rows, cur_rows
             FROM (SELECT *, unnest(range(1, 11)) AS bin FROM span) LEFT JOIN counts USING (col, bin)),
    shares AS (SELECT col, bin, greatest(n_ref / ref_rows, 1e-6) AS e, n_cur / cur_rows AS a FROM grid),
    psi AS (SELECT col, sum(CASE WHEN a = 0 THEN 'inf'::DOUBLE ELSE (e - a) * ln(e / a) END) AS psi
            FROM shares GROUP BY col)"""


def _figures_sql(held: str) -> str:
    places = ", ".join(
        f"round(list_sort({held})[CAST(least(len({held}) * {p} // 100, len({held}) - 1) AS INTEGER) + 1], 9) AS p{p}_ms"
        for p in PERCENTILES
    )
    return f"round(list_avg({held}), 9) AS mean_ms, {places}"


def _snapshot_sql(keys: str, rows: int) -> str:
    by = "PARTITION BY event_type" if keys else ""
    group = "GROUP BY event_type" if keys else ""
    join = "USING (event_type)" if keys else "ON true"
    key = "event_type, " if keys else ""
    return f"""
        WITH totals AS (
            SELECT {key} count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS e,
                   (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS up FROM events {group}),
        held AS (SELECT {key} list(value) AS h FROM (
                    SELECT event_type, value, row_number() OVER ({by} ORDER BY ts DESC, event_id DESC) AS place FROM events)
                 WHERE place <= {rows} {group})
        SELECT {'event_type AS service,' if keys else ''} n AS total_requests, e AS total_errors, round(up, 6) AS uptime_seconds,
               round(e / greatest(n, 1), 6) AS error_rate, round(n / greatest(up, 1.0), 6) AS throughput_rps,
               {_figures_sql('h')}
        FROM totals JOIN held {join}"""


ORACLES = {
    "psi_bin_counts": f'WITH {_PSI} SELECT col AS "column", CAST(bin AS INTEGER) AS bin, n_ref, n_cur FROM grid',
    "psi_per_column": f"""WITH {_PSI} SELECT col AS "column", round(psi, 6) AS psi, 'ok' AS status FROM psi""",
    "psi_dataset": f"""
        WITH {_PSI},
        ranked AS (SELECT col, psi, list_position(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'], col) AS r FROM psi)
        SELECT avg(CASE WHEN psi > 0.0001 THEN 1.0 ELSE 0.0 END) > 0.3 AS dataset_drift,
               round(avg(CASE WHEN psi > 0.0001 THEN 1.0 ELSE 0.0 END), 6) AS drift_score,
               coalesce(string_agg(col, ',' ORDER BY r) FILTER (WHERE psi > 0.0001), '') AS drifted
        FROM ranked""",
    "ks_drift": f"""
        WITH {_LONG},
        vals AS (SELECT col, v, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
                 FROM long GROUP BY col, v),
        cum AS (SELECT col, sum(r) OVER w AS ur, sum(c) OVER w AS uc, sum(r) OVER (PARTITION BY col) AS nr,
                       sum(c) OVER (PARTITION BY col) AS nc
                FROM vals WINDOW w AS (PARTITION BY col ORDER BY v)),
        ks AS (SELECT col, max(abs(ur / nr - uc / nc)) AS d, max(nr)::DOUBLE AS nr, max(nc)::DOUBLE AS nc FROM cum GROUP BY col),
        x AS (SELECT col, d, sqrt(nr * nc / (nr + nc)) * d AS x FROM ks),
        p AS (SELECT col, d, CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101),
                     lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * x * x))))) END AS p FROM x)
        SELECT col AS "column", round(d, 6) AS statistic, round(p, 6)::DOUBLE AS p_value, p < 0.05 AS drift_detected FROM p""",
    "chi2_drift": """
        WITH long AS (SELECT o_orderdate < TIMESTAMP '1998-06-01' AS is_ref,
                             unnest(['o_orderstatus', 'o_orderpriority']) AS col,
                             unnest([o_orderstatus, o_orderpriority]) AS v FROM orders),
        counts AS (SELECT col, v, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
                   FROM long WHERE v IS NOT NULL GROUP BY col, v),
        shares AS (SELECT col, c, r / sum(r) OVER (PARTITION BY col) * sum(c) OVER (PARTITION BY col) AS e FROM counts),
        stat AS (SELECT col, count(*) AS k, sum((c - e) * (c - e) / e) AS x FROM shares GROUP BY col),
        -- both columns have an odd number of categories, so the tail is a finite sum
        p AS (SELECT col, x, exp(-x / 2) * list_sum(list_transform(range(0, (k - 1) // 2),
                     lambda j: pow(x / 2, j) / gamma(j + 1))) AS p FROM stat)
        SELECT col AS "column", round(x, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drift_detected FROM p""",
    "retrain_decision": f"""
        WITH {_PSI},
        report AS (SELECT avg(CASE WHEN psi > 0.2 THEN 1.0 ELSE 0.0 END) AS score FROM psi),
        seen AS (SELECT score, score > 0.3 AS flag, (SELECT count(*) FROM labels) AS f FROM report)
        SELECT (flag AND score >= 0.25) OR f >= 300 AS should_retrain,
               CASE WHEN flag AND score >= 0.25 THEN printf('Dataset drift detected (score=%.3f)', score)
                    WHEN f >= 300 THEN printf('Feedback threshold reached (%d samples)', f)
                    ELSE printf('No trigger (drift=%.3f, feedback=%d)', score, f) END AS reason
        FROM seen""",
    "latency_snapshot": _snapshot_sql("", 1000),
    "latency_snapshot_by_service": _snapshot_sql("event_type", 1000),
    "latency_alerts": """
        WITH held AS (SELECT list_sort(list(value)) AS h FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)),
        seen AS (SELECT h[CAST(least(len(h) * 99 // 100, len(h) - 1) AS INTEGER) + 1] AS p99,
                        (SELECT avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) FROM events) AS rate FROM held)
        SELECT 'p99 latency ' || regexp_replace(printf('%.2f', p99), '0$', '') || 'ms exceeds threshold 200ms' AS alert
        FROM seen WHERE p99 > 200
        UNION ALL
        SELECT 'Error rate ' || printf('%.2f', rate * 100) || '% exceeds threshold 1.00%' FROM seen WHERE rate > 0.01""",
    "latency_rolling": f"""
        WITH held AS (SELECT event_type, event_id, list(value) OVER (
                          PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN {ROLLING - 1} PRECEDING AND CURRENT ROW) AS h
                      FROM events)
        SELECT event_type AS service, event_id AS seq, {_figures_sql('h')} FROM held""",
    "status_counts": """
        SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, count(*) AS requests
        FROM events GROUP BY 1""",
    "latency_histogram": """
        WITH ok AS (SELECT value / 1000 AS s FROM events WHERE event_type <> 'error'),
        le AS (SELECT unnest(['0.01', '0.05', '0.1', '0.25', '0.5', '1.0', '2.0', '+Inf']) AS le,
                      unnest([0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 'inf'::DOUBLE]) AS b)
        SELECT le, count(*) FILTER (WHERE s <= b) AS requests, round(sum(s), 4) AS seconds_sum, count(*) AS seconds_count
        FROM le, ok GROUP BY le""",
    "stream_ingest": """
        SELECT 'kafka:events:' || (user_id % 4) || ':' || event_id AS source,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k, '1.0' AS schema_version
        FROM events WHERE event_type <> 'error'""",
    "stream_quarantine": """
        SELECT 'kafka:events:' || (user_id % 4) || ':' || event_id AS source, '{broken' AS payload
        FROM events WHERE event_type = 'error'""",
    "stream_status_counts": """
        SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, count(*) AS requests
        FROM events GROUP BY 1""",
    "stream_rolling_latency": f"""
        WITH held AS (SELECT event_type, list(value) AS h FROM (
                          SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS place
                          FROM events) WHERE place <= {ROLLING} GROUP BY event_type)
        SELECT event_type AS service, {_figures_sql('h')} FROM held""",
    "stream_feedback": """
        SELECT event_type AS true_label, 'api' AS source, count(*) AS feedback_rows FROM events GROUP BY 1""",
}

ORACLES["saved_report"] = ORACLES["psi_dataset"]
ORACLES["retrain_trigger"] = f"""
        WITH {_PSI},
        report AS (SELECT avg(CASE WHEN psi > 0.2 THEN 1.0 ELSE 0.0 END) AS score FROM psi),
        seen AS (SELECT score, score > 0.3 AS flag, (SELECT count(*) FROM labels) AS f FROM report)
        SELECT CASE WHEN flag AND score >= 0.25 THEN printf('Dataset drift detected (score=%.3f)', score)
                    ELSE printf('Feedback threshold reached (%d samples)', f) END AS reason
        FROM seen, range(2) t(attempt) WHERE (flag AND score >= 0.25) OR (f >= 1 AND attempt = 0)"""
ORACLES["profile_drift"] = f"""
        WITH {_PSI},
        vals AS (SELECT col, v, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM long GROUP BY col, v),
        cum AS (SELECT col, sum(r) OVER w AS ur, sum(c) OVER w AS uc, sum(r) OVER (PARTITION BY col) AS nr, sum(c) OVER (PARTITION BY col) AS nc
                FROM vals WINDOW w AS (PARTITION BY col ORDER BY v)),
        flags AS (SELECT l_returnflag AS v, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-06-01') AS r,
                         count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-06-01') AS c
                  FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1),
        expected AS (SELECT c, r / sum(r) OVER () * sum(c) OVER () AS e FROM flags)
        SELECT col AS "column", 'psi' AS test, round(psi, 6) AS statistic FROM psi
        UNION ALL SELECT col, 'ks', round(max(abs(ur / nr - uc / nc)), 6) FROM cum GROUP BY col
        UNION ALL SELECT 'l_returnflag', 'chi2', round(sum(CASE WHEN e = 0 THEN 'inf'::DOUBLE ELSE (c - e) * (c - e) / e END), 6) FROM expected"""
