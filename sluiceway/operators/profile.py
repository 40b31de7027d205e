"""Table profiles: value counts, missing values, histograms, summary statistics."""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.columns import quoted, valid_double
from sluiceway.operators.ranking import (
    ValueRange,
    equal_width_bin,
    exact_quantiles,
    finite_double,
    values_in_ranges,
)
from sluiceway.schemas import numeric_columns


def preview(df: DataFrame, rows: int = 5) -> tuple[tuple[int, int], DataFrame]:
    """Shape (rows, columns) and the first rows."""
    return (df.count(), len(df.columns)), df.limit(rows)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, with the share rounded to 3 decimals; nulls excluded."""
    counts = df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select("value", "rows", F.round(F.col("rows") / total, 3).alias("share")).orderBy(
        F.desc("rows"), F.asc("value")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Percentage of nulls per column, highest first, complete columns left out. One pass."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    shares = []
    for i, c in enumerate(df.columns):
        missing = quoted(c).isNull() | F.isnan(quoted(c)) if c in floating else quoted(c).isNull()
        shares.append((F.count_if(missing) * 100.0 / F.count(F.lit(1))).alias(f"c{i}"))
    names = F.array(*[F.lit(c) for c in df.columns])
    wide = df.agg(*shares)
    rows = wide.select(F.posexplode(F.array(*[F.col(c) for c in wide.columns])).alias("i", "null_pct"))
    return (
        rows.where("null_pct > 0")
        .select(F.get(names, F.col("i")).alias("column"), "null_pct")
        .orderBy(F.desc("null_pct"), F.asc("column"))
    )


def column_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """{column: (valid rows, min, max, mean, sample deviation)} in one pass; NaN and null skipped."""
    aggs = []
    for i, c in enumerate(columns):
        v = finite_double(c)
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.avg(valid_double(c)).alias(f"mean{i}"),
            F.stddev_samp(valid_double(c)).alias(f"std{i}"),
        ]
    if not columns:
        return {}
    row = list(df.agg(*aggs).first())
    return {c: tuple(row[5 * i : 5 * i + 5]) for i, c in enumerate(columns)}


def numeric_histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins per numeric column: column, bin (0-based), lower, upper, rows.

    Bins are closed on the left, the last one on both sides; a constant column gets a range of one
    around its value. One pass for the ranges, one for all counts; tasks send at most
    bins x columns counters. Empty bins are listed with zero rows.
    """
    columns = numeric_columns(df.schema) if columns is None else columns
    ranges = []
    for c, (rows, low, high, *_) in column_stats(df, columns).items():
        if rows:
            ranges.append(ValueRange(c, low, high) if low < high else ValueRange(c, low - 0.5, low + 0.5))
    if not ranges:
        return df.sparkSession.createDataFrame([], "column string, bin int, lower double, upper double, rows bigint")
    low, width = F.col("low"), (F.col("high") - F.col("low")) / bins
    v, near = F.col("v"), F.col("near")
    counts = (
        values_in_ranges(df, ranges)
        .withColumn("near", equal_width_bin(bins))
        # The division may land one bin off; the edges decide.
        .withColumn(
            "bin",
            F.when(v < low + near * width, near - 1)
            .when((v >= low + (near + 1) * width) & (near < bins - 1), near + 1)
            .otherwise(near),
        )
        .groupBy("r", "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    spans = [
        F.struct(F.lit(i).alias("r"), F.lit(x.column).alias("column"), F.lit(x.low).alias("low"), F.lit(x.high).alias("high"))
        for i, x in enumerate(ranges)
    ]
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(F.array(*spans)).alias("s"))
        .select("s.*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    )
    return grid.join(counts, ["r", "bin"], "left").select(
        "column",
        "bin",
        (low + F.col("bin") * width).alias("lower"),
        (low + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
    )


def _open_end(v: float | None) -> float | None:
    """The largest finite values stand for the infinities that were drawn in to them."""
    return math.copysign(math.inf, v) if v is not None and abs(v) == sys.float_info.max else v


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, exact quartiles, max."""
    columns = numeric_columns(df.schema) if columns is None else columns
    stats = column_stats(df, columns)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], stats)
    rows = [
        (c, stats[c][0], stats[c][3], stats[c][4], _open_end(stats[c][1]), *quartiles[c], _open_end(stats[c][2])) for c in columns
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double",
    )
