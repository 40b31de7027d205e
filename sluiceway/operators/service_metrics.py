"""Latency, error and throughput figures over a request log."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluiceway.functions.clock import seconds_between
from sluiceway.functions.columns import percent_text, quoted, short_decimal
from sluiceway.operators.ranking import exact_positions, first_per_group, overlapping_chunks

# Window length, percentiles, histogram borders in seconds, alert limits.
WINDOW = 1000
PERCENTILES = (50, 95, 99)
LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0)
P99_LIMIT_MS = 200
ERROR_RATE_LIMIT = 0.01


def sorted_percentile(ordered: Column, p: float) -> Column:
    """Element int(n * p / 100) of a sorted array, the last one at most; 0.0 for an empty array."""
    n = F.size(ordered)
    at = F.least(F.floor(n * F.lit(p) / 100), n - 1).cast("int")
    return F.coalesce(F.get(ordered, at), F.lit(0.0))


def window_figures(values: Column) -> list[Column]:
    ordered = F.sort_array(values)
    total = F.aggregate(ordered, F.lit(0.0), lambda acc, x: acc + x)
    mean = F.when(F.size(ordered) > 0, total / F.size(ordered)).otherwise(0.0)
    return [mean.alias("mean_ms"), *[sorted_percentile(ordered, p).alias(f"p{p}_ms") for p in PERCENTILES]]


def service_snapshot(
    log: DataFrame,
    latency: str = "latency_ms",
    error: str = "error",
    ts: str = "ts",
    seq: str = "seq",
    group: str | None = None,
    window: int = WINDOW,
    uptime_seconds: float | None = None,
) -> DataFrame:
    """Totals over the whole log and latency figures over its last `window` rows, per group or overall.

    Uptime is the span of the log unless given. The last rows are found by a top-k (overall) or by
    a limit that each task applies before the shuffle (per group), so a hot group sends at most
    `window` rows per task, whatever `window` is. An empty log gives a row of zeros when ungrouped.
    """
    up = F.lit(float(uptime_seconds)) if uptime_seconds is not None else F.coalesce(
        seconds_between(F.min(quoted(ts)), F.max(quoted(ts))), F.lit(0.0)
    )
    totals = [
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(quoted(error)).alias("total_errors"),
        up.alias("uptime_seconds"),
    ]
    recency = [F.desc(ts), F.desc(seq)]
    figures = F.collect_list(quoted(latency).cast("double")).alias("recent")
    if group is None:
        recent = log.select(latency, ts, seq).orderBy(*recency).limit(window).agg(figures)
        seen = log.agg(*totals).select("*", recent.scalar().alias("recent"))
        keys = []
    else:
        last = first_per_group(log.select(group, latency, ts, seq), group, recency, window)
        recent = last.groupBy(group).agg(figures)
        seen = log.groupBy(group).agg(*totals).join(recent, group)
        keys = [group]
    n = F.col("total_requests")
    return seen.select(
        *keys,
        "uptime_seconds",
        "total_requests",
        "total_errors",
        (F.col("total_errors") / F.greatest(n, F.lit(1))).alias("error_rate"),
        (n / F.greatest(F.col("uptime_seconds"), F.lit(1.0))).alias("throughput_rps"),
        *window_figures(F.col("recent")),
    )


def check_alerts(
    snapshot: DataFrame, p99_limit_ms: float = P99_LIMIT_MS, error_rate_limit: float = ERROR_RATE_LIMIT
) -> DataFrame:
    """Add `alerts`: a message for each limit that is exceeded."""
    p99, rate = F.col("p99_ms"), F.col("error_rate")
    slow = F.concat(
        F.lit("p99 latency "), short_decimal(p99), F.lit(f"ms exceeds threshold {p99_limit_ms}ms")
    )
    failing = F.concat(
        F.lit("Error rate "), percent_text(rate), F.lit(f" exceeds threshold {error_rate_limit:.2%}")
    )
    return snapshot.withColumn(
        "alerts",
        F.array_compact(F.array(F.when(p99 > p99_limit_ms, slow), F.when(rate > error_rate_limit, failing))),
    )


def rolling_figures(values: np.ndarray, window: int) -> list[np.ndarray]:
    """Mean and percentiles over the last `window` values at every value.

    The window's values are kept in order from row to row: one value goes out and one comes in at a place found by bisection.
    """
    n = np.minimum(np.arange(1, len(values) + 1), window)
    at = [np.minimum((n * p / 100).astype(np.int64), n - 1).tolist() for p in PERCENTILES]
    full = max(0, len(values) - window + 1)
    sums = np.cumsum(values[: len(values) - full])
    if full:
        sums = np.concatenate([sums, np.lib.stride_tricks.sliding_window_view(values, window).sum(axis=1)])
    found = [[0.0] * len(values) for _ in PERCENTILES]
    plain = not np.isnan(values).any()  # a NaN is the largest value and has no place among the others
    numbers, held = values.tolist(), []
    for i, x in enumerate(numbers):
        if plain:
            if i >= window:
                del held[bisect.bisect_left(held, numbers[i - window])]
            bisect.insort(held, x)
        else:
            held = np.sort(values[max(0, i - window + 1) : i + 1])
        for out, place in zip(found, at, strict=True):
            out[i] = held[place[i]]
    return [sums / n, *map(np.array, found)]


def rolling_latency(
    log: DataFrame,
    group: str,
    latency: str = "latency_ms",
    ts: str = "ts",
    seq: str = "seq",
    window: int = WINDOW,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Mean and percentiles over the last `window` rows at every row of each group.

    The frame counts rows, so rows are first numbered within their group by the range-partitioned
    rank and then worked on in chunks of consecutive rows; the tail of a chunk is repeated as history
    of the next. A hot group is as many tasks as it has chunks. Inside a chunk the window moves on row by row
    (`rolling_figures`): nothing is collected or sorted anew for a row.
    """
    size = max(chunk_rows or 8 * window, window)
    numbered = exact_positions(
        log.where(quoted(latency).isNotNull()).select(group, ts, seq, quoted(latency).cast("double").alias("_v")),
        [group],
        [ts, seq],
    )
    chunks = overlapping_chunks(numbered, "pos", size, window - 1)
    names = ["mean_ms", *[f"p{p}_ms" for p in PERCENTILES]]
    schema = T.StructType([*log.select(group, ts, seq).schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def rolled(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        home = pa.array(table["home"].to_numpy())
        figures = rolling_figures(table["_v"].to_numpy(), window)
        out = table.select([group, ts, seq])
        for name, x in zip(names, figures, strict=True):
            out = out.append_column(name, pa.array(x))
        return out.filter(home)

    return chunks.groupBy(group, "chunk").applyInArrow(rolled, schema)


def status_counts(log: DataFrame, status: str = "status") -> DataFrame:
    """Requests per status."""
    return log.groupBy(status).agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(log: DataFrame, seconds: Column, ok: Column | None = None, buckets=LATENCY_BUCKETS) -> DataFrame:
    """Cumulative histogram of successful requests: le, requests, plus total seconds and count on each row."""
    seen = log.where(ok) if ok is not None else log
    names = [*[str(b) for b in buckets], "+Inf"]
    counts = [F.count_if(F.col("_s") <= b) for b in buckets] + [F.count("_s")]
    wide = seen.select(seconds.cast("double").alias("_s")).agg(
        F.array(*counts).alias("counts"),
        F.coalesce(F.sum("_s"), F.lit(0.0)).alias("seconds_sum"),
        F.count("_s").alias("seconds_count"),
    )
    rows = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("le"), F.col("counts").alias("requests"))
    return wide.select(F.inline(rows).alias("le", "requests"), "seconds_sum", "seconds_count")
