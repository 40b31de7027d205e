import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.operators import drift, ranking, service_metrics
from sluiceway.operators.drift import (
    check_drift,
    chi2_statistics,
    chi2_tests,
    drift_report,
    ks_statistics,
    ks_tests,
    psi_bins,
    psi_scores,
    retrain_decision,
)
from sluiceway.operators.service_metrics import (
    check_alerts,
    latency_histogram,
    rolling_latency,
    service_snapshot,
    status_counts,
)
from sluiceway.plans.monitoring import run_monitoring
from sluiceway.sources.files import feedback_count

START = dt.datetime(2024, 1, 1)
LOG = "seq bigint, ts timestamp, service string, latency_ms double, error boolean"


def log_of(spark, latencies, errors=(), service="s"):
    rows = [
        (i, START + dt.timedelta(seconds=i), service, float(v), i in errors) for i, v in enumerate(latencies)
    ]
    return spark.createDataFrame(rows, LOG)


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


# ---- service metrics ----------------------------------------------------------------------------


def test_empty_log_gives_zeros(spark):
    row = service_snapshot(log_of(spark, [])).first()
    assert (row.total_requests, row.error_rate, row.p50_ms, row.mean_ms, row.throughput_rps) == (0, 0.0, 0.0, 0.0, 0.0)


def test_percentiles_take_the_sorted_index(spark):
    row = service_snapshot(log_of(spark, range(1, 101)), window=100).first()
    assert (row.p50_ms, row.p95_ms, row.p99_ms) == (51.0, 96.0, 100.0)


def test_window_keeps_the_last_rows_but_totals_count_all(spark):
    row = service_snapshot(log_of(spark, range(10)), window=5).first()
    assert (row.mean_ms, row.total_requests) == (7.0, 10)


def test_error_rate_and_throughput(spark):
    row = service_snapshot(log_of(spark, [50, 100, 200], {2})).first()
    assert (row.total_requests, row.total_errors) == (3, 1)
    assert row.error_rate == pytest.approx(1 / 3)
    assert row.uptime_seconds == 2.0 and row.throughput_rps == pytest.approx(1.5)


@pytest.mark.parametrize(
    "latencies, all_fail, limits, expected",
    [
        ([500] * 100, False, (200, 0.5), ["p99 latency 500.0ms exceeds threshold 200ms"]),
        ([10] * 10, True, (1000, 0.05), ["Error rate 100.00% exceeds threshold 5.00%"]),
        ([10] * 50, False, (200, 0.05), []),
        ([200] * 50, False, (200, 0.05), []),
    ],
)
def test_alerts(spark, latencies, all_fail, limits, expected):
    log = log_of(spark, latencies, set(range(len(latencies))) if all_fail else ())
    assert check_alerts(service_snapshot(log), *limits).first().alerts == expected


def test_snapshot_per_service(spark):
    log = log_of(spark, range(10), service="a").unionByName(log_of(spark, [5.0], {0}, service="b"))
    rows = {r.service: r for r in service_snapshot(log, group="service", window=4).collect()}
    assert (rows["a"].mean_ms, rows["a"].total_requests, rows["b"].error_rate, rows["b"].p99_ms) == (7.5, 10, 1.0, 5.0)


def test_long_windows_are_limited_where_the_rows_are(spark, monkeypatch):
    log = log_of(spark, range(200), service="a").unionByName(log_of(spark, [1.0, 2.0], service="b"))
    expected = [tuple(r) for r in service_snapshot(log, group="service", window=30).orderBy("service").collect()]
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 3)
    assert [tuple(r) for r in service_snapshot(log, group="service", window=30).orderBy("service").collect()] == expected


def test_any_number_of_last_rows_sends_that_many_per_task(spark, monkeypatch):
    from pyspark.sql import functions as F

    draw = random.Random(2)
    rows = [(draw.choice(["hot", "hot", "hot", "b", None]), draw.choice([None, *range(40)]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, o int, i int").repartition(6)
    order = [F.desc("o"), F.asc("i")]
    expected = {}
    for g, o, i in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])):
        expected.setdefault(g, []).append(i)
    for merged_tasks in (256, 2):
        monkeypatch.setattr(ranking, "MERGED_TASKS", merged_tasks)
        for n in (1500, 2):
            monkeypatch.setattr(ranking, "GROUP_LIMIT", min(1000, n - 1))
            got = {}
            for r in ranking.first_per_group(df, "g", order, n).collect():
                got.setdefault(r.g, set()).add(r.i)
            assert got == {g: set(ids[:n]) for g, ids in expected.items()}
    local = df.sortWithinPartitions("g", *order)
    sent = local.mapInArrow(ranking._first_of_runs("g", 7), local.schema).withColumn("task", F.spark_partition_id())
    assert sent.groupBy("g", "task").count().agg(F.max("count")).first()[0] <= 7


@pytest.mark.parametrize("window", [1, 10, 1000, 5000])
def test_rolling_figures_equal_windows_sorted_anew(window):
    import numpy as np

    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=6000 if window > 500 else 300), 1)
    mean, *parts = service_metrics.rolling_figures(values, window)
    for i in [0, 1, 5, 99, 299, *([1000, 4999, 5000, 5999] if window > 500 else [])]:
        held = np.sort(values[max(0, i - window + 1) : i + 1])
        assert [x[i] for x in parts] == [held[min(int(len(held) * p / 100), len(held) - 1)] for p in (50, 95, 99)]
        assert mean[i] == pytest.approx(held.mean())
    odd = service_metrics.rolling_figures(np.array([1.0, np.nan, np.inf, 2.0]), 2)
    assert np.isnan(odd[3][1]) and odd[3][3] == np.inf and len(service_metrics.rolling_figures(np.zeros(0), 3)[0]) == 0


def test_rolling_latency_over_chunks_equals_a_plain_window(spark):
    draw = random.Random(5)
    rows = [
        (i, START + dt.timedelta(seconds=i // 7), "hot" if draw.random() < 0.7 else "cold", draw.uniform(1, 9) if i % 11 else None, False)
        for i in range(600)
    ]
    log = spark.createDataFrame(rows, LOG)
    got = {r.seq: r for r in rolling_latency(log, "service", window=10, chunk_rows=25).collect()}
    seen: dict = {}
    for seq, _, service, value, _ in rows:
        if value is None:
            assert seq not in got
            continue
        held = (seen.get(service, []) + [value])[-10:]
        seen[service] = held
        ordered = sorted(held)
        expected = [ordered[min(int(len(held) * p / 100), len(held) - 1)] for p in (50, 95, 99)]
        assert [got[seq].p50_ms, got[seq].p95_ms, got[seq].p99_ms] == expected
        assert got[seq].mean_ms == pytest.approx(sum(held) / len(held))


def test_status_counts_and_histogram(spark):
    log = log_of(spark, [5, 10, 40, 300, 9000], {2}).withColumn("status", F.when(F.col("error"), "error").otherwise("ok"))
    assert {r.status: r.requests for r in status_counts(log).collect()} == {"ok": 4, "error": 1}
    rows = latency_histogram(log, F.col("latency_ms") / 1000, F.col("status") == "ok").collect()
    assert [(r.le, r.requests) for r in rows] == [
        ("0.01", 2), ("0.05", 2), ("0.1", 2), ("0.25", 2), ("0.5", 3), ("1.0", 3), ("2.0", 3), ("+Inf", 4)
    ]
    assert rows[0].seconds_sum == pytest.approx(9.315) and rows[0].seconds_count == 4


# ---- drift --------------------------------------------------------------------------------------


def psi_of(spark, ref, cur, **options):
    return psi_scores(numbers(spark, ref), numbers(spark, cur), **options).first()


def test_psi_of_equal_data_is_zero(spark):
    assert psi_of(spark, range(100), range(100)).psi == 0.0


def test_psi_matches_a_direct_computation(spark):
    draw = random.Random(2)
    ref = [draw.gauss(0, 1) for _ in range(500)] + [None, float("nan")]
    cur = [draw.gauss(0.5, 1.2) for _ in range(400)] + [99.0, -99.0]
    edges = np.linspace(min(ref[:500]), max(ref[:500]), 11)
    place = lambda x: np.bincount(np.searchsorted(edges[1:-1], x, side="left"), minlength=10)
    e = np.maximum(place(ref[:500]) / 500, 1e-6)
    a = place(cur) / len(cur)
    got = psi_of(spark, ref, cur)
    assert got.status == "ok" and got.psi == pytest.approx(float(((e - a) * np.log(e / a)).sum()))


def test_psi_bins_are_closed_on_the_right(spark):
    bins = psi_bins(numbers(spark, range(11)), numbers(spark, [1.0, 1.5, 2.0, -5.0, 50.0])).collect()
    assert {r.bin: r.n_cur for r in bins if r.n_cur} == {1: 2, 2: 2, 10: 1}
    assert sum(r.n_ref for r in bins) == 11 and len(bins) == 10


def test_psi_with_an_empty_current_bin(spark):
    assert psi_of(spark, range(100), range(50)).psi == math.inf
    assert math.isfinite(psi_of(spark, range(100), range(50), floor_actual=True).psi)


def test_psi_with_an_empty_current_column(spark):
    assert psi_of(spark, range(100), [None, float("nan")]).psi == 0.0


@pytest.mark.parametrize(
    "ref, status",
    [([5, 5, 5], "constant_reference"), ([None, None], "empty_reference"), ([1, math.inf], "infinite_reference")],
)
def test_psi_without_usable_reference(spark, ref, status):
    row = psi_of(spark, ref, [1, 2, 3])
    assert row.psi is None and row.status == status


def test_report_lists_drifted_columns_in_order_and_skips_unusable_ones(spark):
    base = spark.range(200)
    ref = base.select(F.col("id").alias("z"), (F.col("id") % 10).alias("a"), F.lit(1).alias("k"), F.lit("t").alias("name"))
    cur = base.select((F.col("id") + 500).alias("z"), (F.col("id") % 10).alias("a"), F.lit(1).alias("k"), F.lit("t").alias("name"))
    row = drift_report(psi_scores(ref, cur)).first()
    assert row.drifted_columns == ["z"] and row.drift_score == 0.5 and row.dataset_drift
    assert set(row.details) == {"z", "a"} and row.details["z"] == math.inf


def test_report_without_numeric_columns(spark):
    df = spark.createDataFrame([("a",)], "t string")
    row = drift_report(psi_scores(spark.createDataFrame([(1.0,)], "x double"), spark.createDataFrame([(None,)], "x double"))).first()
    assert row.drift_score == 0.0 and not row.dataset_drift and row.drifted_columns == []
    assert df.count() == 1


def direct_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("shape", ["spread", "hot", "same", "apart"])
def test_ks_is_exact(spark, shape):
    draw = random.Random(9)
    ref = [draw.gauss(0, 1) for _ in range(900)]
    cur = [draw.gauss(0.1, 1) for _ in range(700)]
    if shape == "hot":
        ref = [0.25 if draw.random() < 0.5 else x for x in ref]
        cur = [0.25 if draw.random() < 0.4 else x * 1e6 for x in cur]
    if shape == "same":
        cur = list(ref)
    if shape == "apart":
        cur = [x + 100 for x in cur]
    row = ks_statistics(numbers(spark, [*ref, None]), numbers(spark, [*cur, float("nan")])).first()
    assert row.ks == pytest.approx(direct_ks(ref, cur), abs=1e-12)
    assert (row.ref_rows, row.cur_rows) == (900, 700 if shape != "same" else 900)


def test_ks_decision(spark):
    rows = ks_tests(numbers(spark, range(1000)), numbers(spark, [x + 200 for x in range(1000)])).collect()
    assert rows[0].drift_detected and rows[0].statistic == pytest.approx(0.2) and rows[0].p_value < 1e-10
    same = ks_tests(numbers(spark, range(1000)), numbers(spark, range(1000))).first()
    assert not same.drift_detected and same.p_value == 1.0


def test_chi2_against_reference_shares(spark):
    ref = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40 + [(None,)], "c string")
    cur = spark.createDataFrame([("a",)] * 20 + [("b",)] * 30, "c string")
    row = chi2_statistics(ref, cur).first()
    assert row.chi2 == pytest.approx((20 - 30) ** 2 / 30 + (30 - 20) ** 2 / 20) and row.categories == 2
    assert chi2_tests(ref, cur).first().p_value == pytest.approx(math.erfc(math.sqrt(row.chi2 / 2)))
    new = spark.createDataFrame([("zz",)], "c string")
    assert chi2_tests(ref, new).first().statistic == math.inf and chi2_tests(ref, new).first().drift_detected


def test_chi2_tail_known_values():
    # 95 % points of the distribution
    for freedom, point in [(1, 3.841), (2, 5.991), (3, 7.815), (4, 9.488), (10, 18.307)]:
        assert drift._chi2_tail(point, freedom) == pytest.approx(0.05, abs=1e-4)


def test_check_drift_raises_what_a_test_raises(spark, monkeypatch):
    ref, cur = numbers(spark, range(100)), numbers(spark, [x + 500 for x in range(100)])
    assert check_drift(ref, cur).first().drifted_columns == ["x"]

    def broken(*_):
        raise ValueError("no test")

    monkeypatch.setattr(drift, "ks_tests", broken)
    with pytest.raises(ValueError, match="no test"):
        check_drift(ref, cur)


@pytest.mark.parametrize(
    "score, flag, feedback, expected",
    [
        (0.5, True, 0, (True, "Dataset drift detected (score=0.500)")),
        (0.28, False, 0, (False, "No trigger (drift=0.280, feedback=0)")),
        (0.0, False, 500, (True, "Feedback threshold reached (500 samples)")),
        (0.0, False, 499, (False, "No trigger (drift=0.000, feedback=499)")),
        (0.2, True, 500, (True, "Feedback threshold reached (500 samples)")),
    ],
)
def test_retrain_rule(spark, score, flag, feedback, expected):
    report = spark.createDataFrame([(flag, score)], "dataset_drift boolean, drift_score double")
    assert tuple(retrain_decision(report, feedback).first()) == expected


def test_feedback_count_is_flat_and_zero_when_absent(spark, tmp_path):
    assert feedback_count(spark, str(tmp_path / "none")).first()[0] == 0
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.jsonl").write_text("{}\n{}\n")
    (tmp_path / "note.txt").write_text("x\n")
    (tmp_path / "deep" / "b.jsonl").write_text("{}\n")
    assert feedback_count(spark, str(tmp_path)).first()[0] == 2


def test_monitoring_run(spark, tmp_path):
    ref, cur = numbers(spark, range(100)), numbers(spark, [x + 500 for x in range(100)])
    found = run_monitoring(
        ref, cur, str(tmp_path / "feedback"), log_of(spark, [500] * 20), str(tmp_path / "reports"), str(tmp_path / "triggers"), "psi"
    )
    assert found["decision"].first().should_retrain
    assert found["snapshot"].first().alerts == ["p99 latency 500.0ms exceeds threshold 200ms"]
    assert spark.read.json(str(tmp_path / "reports")).first().drifted_columns == ["x"]
    assert spark.read.json(str(tmp_path / "triggers")).first().reason == "Dataset drift detected (score=1.000)"


def test_drift_without_comparable_columns_and_of_ids(spark):
    ref = spark.createDataFrame([(f"r{i}", "ab"[i % 2]) for i in range(40)], "id string, c string")
    cur = spark.createDataFrame([(f"c{i}", "ab"[i % 2]) for i in range(40)], "id string, c string")
    row = check_drift(ref, cur).first()
    assert (row.dataset_drift, row.drifted_columns, set(row.details), row.details["id"]) == (False, [], {"c", "id"}, None)
    # A column with nearly a category per row is listed as not tested; with no other column there is no decision.
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    row = check_drift(few, spark.createDataFrame([("z",)] * 50, "c string")).first()
    assert (row.dataset_drift, row.drift_score, row.drifted_columns, row.details) == (None, None, [], {"c": None})
    assert tuple(retrain_decision(check_drift(few, few), 3).first()) == (False, "No trigger (drift=0.000, feedback=3)")
    row = check_drift(few.union(few).union(few), spark.createDataFrame([("z",)] * 50, "c string")).first()
    assert (row.dataset_drift, row.drifted_columns) == (True, ["c"])
    other = cur.toDF("x", "y")
    for method in ("psi", "tests"):
        row = check_drift(ref, other, method).first()
        assert (row.dataset_drift, row.drift_score, row.drifted_columns, row.details) == (False, 0.0, [], {})
    assert ks_statistics(ref, other).count() == 0 and chi2_statistics(ref, other).count() == 0


@pytest.mark.parametrize("x, freedom, tail", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (1.145476226061769, 5, 0.95), (124.34211340400407, 100, 0.05)])
def test_chi2_tail(x, freedom, tail):
    assert drift._chi2_tail(x, freedom) == pytest.approx(tail, abs=1e-10)


def test_chi2_tail_of_many_categories():
    assert drift._chi2_tail(1e8, 10**8) == pytest.approx(0.5, abs=1e-4)
