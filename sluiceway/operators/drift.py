"""Distribution drift between a reference and a current table, and the retraining decision."""

from __future__ import annotations

import math
import warnings

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sluiceway.functions.columns import double_lit, quoted, valid_double
from sluiceway.operators.ranking import ValueRange, equal_width_bin, finite_double, long_values
from sluiceway.schemas import numeric_columns
from sluiceway.session import to_scratch_table

# Fixed values of the drift rules.
PSI_BUCKETS = 10
PSI_FLOOR = 1e-6
PSI_THRESHOLD = 0.2
DRIFT_SHARE = 0.3
RETRAIN_SCORE = 0.25
RETRAIN_FEEDBACK = 500
TEST_P_VALUE = 0.05
TEST_DRIFT_SHARE = 0.5

KS_BINS = 256
# Parts of a bin that is opened again, and the most distinct values that are ranked in one window.
KS_CUTS = 32
KS_WINDOW_ROWS = 1_000_000
# Text columns with more categories than this share of their reference rows are ids or free text.
CATEGORY_SHARE = 0.5

_PSI_BINS = "r int, column string, status string, ref_rows bigint, cur_rows bigint, bin int, n_ref bigint, n_cur bigint"
_KS = "column string, ref_rows bigint, cur_rows bigint, ks double"
_CHI2 = "column string, categories bigint, ref_share double, chi2 double"


def shared_numeric_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Numeric columns of the reference which the current table has too."""
    return [c for c in numeric_columns(reference.schema) if c in current.columns]


def _both(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """The compared columns of both tables, told apart by `_is_ref`."""
    wanted = [quoted(c) for c in columns]
    return reference.select(F.lit(True).alias("_is_ref"), *wanted).unionByName(
        current.select(F.lit(False).alias("_is_ref"), *wanted)
    )


# ---- population stability index -----------------------------------------------------------------


def _psi_ranges(both: DataFrame, columns: list[str]) -> list[tuple[ValueRange, str, int, int]]:
    """(reference range, status, reference rows, current rows) per column, from one aggregate."""
    aggs = []
    for c in columns:
        ref = F.when(F.col("_is_ref"), valid_double(c))
        aggs += [F.min(ref), F.max(ref), F.count(ref), F.count(F.when(~F.col("_is_ref"), valid_double(c)))]
    row = list(both.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first())
    return [psi_range(c, *row[4 * i : 4 * i + 4]) for i, c in enumerate(columns)]


def psi_range(column: str, low: float, high: float, n_ref: int, n_cur: int) -> tuple[ValueRange, str, int, int]:
    """Range and status of one column from the reference's extremes and both row counts."""
    if not n_ref:
        status, low, high = "empty_reference", 0.0, 0.0
    elif math.isinf(low) or math.isinf(high):
        status, low, high = "infinite_reference", 0.0, 0.0
    else:
        status = "constant_reference" if low == high else "ok"
    return ValueRange(column, low, high), status, n_ref, n_cur


def psi_bins(reference: DataFrame, current: DataFrame, columns: list[str] | None = None, buckets: int = PSI_BUCKETS) -> DataFrame:
    """Rows of both tables per reference bin: r, column, status, ref_rows, cur_rows, bin, n_ref, n_cur.

    Equal-width bins over the reference range, closed on the right; the outer bins take everything
    beyond. All columns in one pass, at most buckets x columns counters per task. Every bin of a
    usable column is listed, empty or not. Without columns to compare there are no rows.
    """
    columns = shared_numeric_columns(reference, current) if columns is None else columns
    if not columns:
        return reference.sparkSession.createDataFrame([], _PSI_BINS)
    both = _both(reference, current, columns)
    fitted = _psi_ranges(both, columns)
    values = long_values(both, [f[0] for f in fitted if f[1] == "ok"], F.col("_is_ref")) if any(f[1] == "ok" for f in fitted) else None
    counts = values and values.groupBy("r", psi_place(buckets).alias("bin")).agg(
        F.count_if(F.col("_is_ref")).alias("n_ref"), F.count_if(~F.col("_is_ref")).alias("n_cur")
    )
    return psi_grid(reference.sparkSession, fitted, counts, buckets)


def psi_place(buckets: int) -> Column:
    """The bin, from 1, of v between low and high."""
    low, width = F.col("low"), (F.col("high") - F.col("low")) / buckets
    v, near = F.col("v"), equal_width_bin(buckets)
    # The division may land one bin off; the edges decide.
    return (
        F.when((v <= low + near * width) & (near > 0), near)
        .when((v > low + (near + 1) * width) & (near < buckets - 1), near + 2)
        .otherwise(near + 1)
    )


def psi_grid(spark: SparkSession, fitted: list[tuple[ValueRange, str, int, int]], counts: DataFrame | None, buckets: int) -> DataFrame:
    """Every bin of every column with its counts (r, bin, n_ref, n_cur); r numbers the usable columns first."""
    ordered = [f for f in fitted if f[1] == "ok"] + [f for f in fitted if f[1] != "ok"]
    spans = [
        F.struct(
            F.lit(i).alias("r"),
            F.lit(x.column).alias("column"),
            F.lit(status).alias("status"),
            F.lit(n_ref).cast("bigint").alias("ref_rows"),
            F.lit(n_cur).cast("bigint").alias("cur_rows"),
        )
        for i, (x, status, n_ref, n_cur) in enumerate(ordered)
    ]
    every_bin = F.when(F.col("status") == "ok", F.sequence(F.lit(1), F.lit(buckets))).otherwise(F.array(F.lit(0)))
    scaffold = (
        spark.range(1)
        .select(F.explode(F.array(*spans)).alias("s"))
        .select("s.*")
        .withColumn("bin", F.explode(every_bin))
    )
    zero = F.lit(0).cast("bigint")
    if counts is None:
        return scaffold.select("*", zero.alias("n_ref"), zero.alias("n_cur"))
    return scaffold.join(counts, ["r", "bin"], "left").select(
        "r",
        "column",
        "status",
        "ref_rows",
        "cur_rows",
        "bin",
        F.coalesce("n_ref", zero).alias("n_ref"),
        F.coalesce("n_cur", zero).alias("n_cur"),
    )


def psi_term(expected: Column, actual: Column, floor_actual: bool = False) -> Column:
    """One bin's share of the index; an empty current bin makes it infinite unless floored."""
    e = F.greatest(expected, F.lit(PSI_FLOOR))
    a = F.greatest(actual, F.lit(PSI_FLOOR)) if floor_actual else actual
    return F.when(a == 0, F.lit("Infinity").cast("double")).otherwise((e - a) * F.ln(e / a))


def psi_scores(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    buckets: int = PSI_BUCKETS,
    floor_actual: bool = False,
) -> DataFrame:
    """r, column, psi, status per shared numeric column.

    A current column without values scores 0. A reference column that is empty, constant or infinite
    has no bins: its psi is null and the status says why.
    """
    return psi_from_bins(psi_bins(reference, current, columns, buckets), floor_actual)


def psi_from_bins(bins: DataFrame, floor_actual: bool = False) -> DataFrame:
    """The scores from the rows of `psi_bins`."""
    # Bins of an unusable or empty column have no shares.
    e = F.when(F.col("ref_rows") > 0, F.col("n_ref") / F.col("ref_rows"))
    a = F.when(F.col("cur_rows") > 0, F.col("n_cur") / F.col("cur_rows"))
    term = F.when(F.col("status") != "ok", None).when(F.col("cur_rows") == 0, 0.0).otherwise(psi_term(e, a, floor_actual))
    return bins.groupBy("r", "column", "status").agg(F.sum(term).alias("psi")).select("r", "column", "psi", "status")


def drift_report(
    scores: DataFrame, threshold: float = PSI_THRESHOLD, drift_share: float = DRIFT_SHARE
) -> DataFrame:
    """One row in the report layout: flag, share of drifted columns, their names, score per column."""
    scored = F.col("psi").isNotNull()
    drifted = scored & (F.col("psi") > threshold)
    named = F.array_sort(F.collect_list(F.when(drifted, F.struct("r", "column"))))
    share = F.count_if(drifted) / F.greatest(F.count_if(scored), F.lit(1))
    return scores.agg(
        share.alias("drift_score"),
        F.transform(named, lambda x: x["column"]).alias("drifted_columns"),
        F.map_from_entries(F.collect_list(F.when(scored, F.struct("column", "psi")))).alias("details"),
    ).select(
        F.current_timestamp().alias("timestamp"),
        (F.col("drift_score") > drift_share).alias("dataset_drift"),
        "drift_score",
        "drifted_columns",
        "details",
    )


# ---- two-sample tests ---------------------------------------------------------------------------


def _tally() -> list[Column]:
    return [F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")]


def ks_statistics(
    reference: DataFrame, current: DataFrame, columns: list[str] | None = None, window_rows: int = KS_WINDOW_ROWS
) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov statistic per numeric column: column, ref_rows, cur_rows, ks.

    Approximate quantiles cut each column into KS_BINS bins of similar size, whatever its shape. Counting rows
    per bin gives the distance of the two distributions at the bin borders and an upper bound inside each bin.
    Only bins whose bound exceeds the largest border distance are opened, see `ks_from_bins`.
    """
    columns = shared_numeric_columns(reference, current) if columns is None else columns
    if not columns:
        return reference.sparkSession.createDataFrame([], _KS)
    both = _both(reference, current, columns).select(
        "_is_ref", *[finite_double(c).alias(f"v{i}") for i, c in enumerate(columns)]
    )
    shares = [k / KS_BINS for k in range(1, KS_BINS)]
    borders = both.stat.approxQuantile([f"v{i}" for i in range(len(columns))], shares, 1 / (8 * KS_BINS))
    values = ks_values(both, [ks_splits(q) for q in borders])
    return ks_from_bins(values.groupBy("r", "bin").agg(*_tally()), values, columns, window_rows)


def ks_splits(borders: list[float]) -> list[float]:
    """Bin borders for `ks_values`; a column without values has one border."""
    return [-math.inf, *(sorted(set(borders)) or [0.0]), math.inf]


def ks_values(both: DataFrame, splits: list[list[float]]) -> DataFrame:
    """r, bin, v, n_ref, n_cur: each value of the columns v0, v1, ... in its bin, counted for the table it is of."""
    binned = Bucketizer(
        splitsArray=splits,
        inputCols=[f"v{i}" for i in range(len(splits))],
        outputCols=[f"b{i}" for i in range(len(splits))],
        handleInvalid="keep",
    ).transform(both)
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("r"), F.col(f"b{i}").cast("bigint").alias("bin"), F.col(f"v{i}").alias("v"))
            for i in range(len(splits))
        ]
    )
    values = binned.select("_is_ref", F.explode(cells).alias("c")).select("_is_ref", "c.*").where("v is not null")
    return values.select(
        "r", "bin", "v", F.col("_is_ref").cast("bigint").alias("n_ref"), (~F.col("_is_ref")).cast("bigint").alias("n_cur")
    )


def _gap(ref: Column, cur: Column) -> Column:
    return F.abs(ref / F.col("ref_rows") - cur / F.col("cur_rows"))


def _inside() -> Column:
    """What the distance can reach between the counts before a cell and those up to its end."""
    ref_before, cur_before = F.col("upto_ref") - F.col("n_ref"), F.col("upto_cur") - F.col("n_cur")
    return F.greatest(
        F.col("upto_ref") / F.col("ref_rows") - cur_before / F.col("cur_rows"),
        F.col("upto_cur") / F.col("cur_rows") - ref_before / F.col("ref_rows"),
    )


def ks_from_bins(bins: DataFrame, values: DataFrame, columns: list[str], window_rows: int = KS_WINDOW_ROWS) -> DataFrame:
    """The statistic from counts per bin (r, bin, n_ref, n_cur) and the values of `ks_values`.

    Branch and bound: bins that can beat the best distance are opened, copies combined; what has more than
    `window_rows` distinct values is cut again by quantiles (`ks_narrowed`), the rest is ranked cell by cell.
    """
    # At most KS_BINS rows per column.
    column = Window.partitionBy("r")
    upto = column.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.select(
        "*",
        F.sum("n_ref").over(upto).alias("upto_ref"),
        F.sum("n_cur").over(upto).alias("upto_cur"),
        F.sum("n_ref").over(column).alias("ref_rows"),
        F.sum("n_cur").over(column).alias("cur_rows"),
    ).where("ref_rows > 0 and cur_rows > 0")
    # Stored, because both the border distances and the choice of bins to open are read from it.
    bins = to_scratch_table(
        bins.select("*", F.max(_gap(F.col("upto_ref"), F.col("upto_cur"))).over(column).alias("best"), _inside().alias("inside")),
        "ks-bins",
    )
    opened = bins.where("inside > best").select(
        "r",
        F.col("bin").alias("cell"),
        (F.col("upto_ref") - F.col("n_ref")).alias("ref_before"),
        (F.col("upto_cur") - F.col("n_cur")).alias("cur_before"),
        "ref_rows",
        "cur_rows",
    )
    # Bounded by KS_BINS rows per compared column.
    held = values.withColumnRenamed("bin", "cell").join(F.broadcast(opened.select("r", "cell")), ["r", "cell"])
    held = to_scratch_table(held.groupBy("r", "cell", "v").agg(*_tally()), "ks-values")
    ranked, cut = ks_narrowed(held, opened, bins.groupBy("r").agg(F.max("best").alias("best")), window_rows)
    rank = Window.partitionBy("r", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    gap = _gap(F.col("ref_before") + F.sum("n_ref").over(rank), F.col("cur_before") + F.sum("n_cur").over(rank))
    found = cut.unionByName(ranked.select("r", gap.alias("best")))
    names = F.array(*[F.lit(c) for c in columns])
    best = found.groupBy("r").agg(F.max("best").alias("ks"))
    return bins.groupBy("r").agg(F.max("ref_rows").alias("ref_rows"), F.max("cur_rows").alias("cur_rows")).join(best, "r").select(
        F.get(names, F.col("r")).alias("column"), "ref_rows", "cur_rows", "ks"
    )


def ks_narrowed(values: DataFrame, cells: DataFrame, best: DataFrame, window_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cut open cells until each holds at most `window_rows` distinct values.

    values: r, cell, v, n_ref, n_cur with one row per value; cells: r, cell, ref_before, cur_before, ref_rows,
    cur_rows; best: r, best. Returns the values of the cells left, with their cells' counts, and the best
    distances at all borders. Each cut value is a cell of its own, so a round always makes cells smaller;
    cells of one value, and those whose bound does not beat the best distance, are done.
    """
    few: list[DataFrame] = []
    shares = F.array(*[F.lit(k / KS_CUTS) for k in range(1, KS_CUTS)])
    while True:
        sizes = to_scratch_table(values.groupBy("r", "cell").agg(F.count(F.lit(1)).alias("size")), "ks-sizes")
        small = sizes.where(F.col("size") <= window_rows).drop("size")
        few.append(values.join(small, ["r", "cell"], "left_semi").join(cells, ["r", "cell"]))
        large = sizes.where(F.col("size") > window_rows).drop("size")
        if large.isEmpty():
            break
        values = values.join(large, ["r", "cell"], "left_semi")
        cuts = values.groupBy("r", "cell").agg(F.percentile_approx("v", shares, F.lit(16 * KS_CUTS)).alias("cuts"))
        cuts = to_scratch_table(cuts, "ks-cuts")
        # Even numbers lie between two cuts, odd ones are the cuts themselves; equal cuts leave numbers out.
        passed = sum(((F.col("v") >= F.get("cuts", F.lit(k))).cast("int") for k in range(KS_CUTS - 1)), F.lit(0))
        place = F.col("cell") * (2 * KS_CUTS) + 2 * F.col("passed") - F.array_contains("cuts", F.col("v")).cast("int")
        values = values.join(cuts, ["r", "cell"]).withColumn("passed", passed)
        values = to_scratch_table(values.select("r", F.col("cell").alias("parent"), place.alias("cell"), "v", "n_ref", "n_cur"), "ks-values")
        family = Window.partitionBy("r", "parent").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        parts = values.groupBy("r", "parent", "cell").agg(*_tally(), F.count(F.lit(1)).alias("size"))
        parts = parts.join(cells.withColumnRenamed("cell", "parent"), ["r", "parent"]).select(
            "r", "cell", "size", "n_ref", "n_cur", "ref_rows", "cur_rows",
            (F.col("ref_before") + F.sum("n_ref").over(family)).alias("upto_ref"),
            (F.col("cur_before") + F.sum("n_cur").over(family)).alias("upto_cur"),
        )
        parts = to_scratch_table(parts.withColumn("inside", _inside()), "ks-cells")
        reached = parts.select("r", _gap(F.col("upto_ref"), F.col("upto_cur")).alias("best"))
        best = to_scratch_table(best.unionByName(reached).groupBy("r").agg(F.max("best").alias("best")), "ks-best")
        # One row per compared column.
        cells = parts.join(F.broadcast(best), "r").where("size > 1 and inside > best").select(
            "r", "cell", (F.col("upto_ref") - F.col("n_ref")).alias("ref_before"),
            (F.col("upto_cur") - F.col("n_cur")).alias("cur_before"), "ref_rows", "cur_rows",
        )
        cells = to_scratch_table(cells, "ks-open")
        values = values.drop("parent").join(cells.select("r", "cell"), ["r", "cell"], "left_semi")
    ranked = few[0]
    for more in few[1:]:
        ranked = ranked.unionByName(more)
    return ranked, best


def ks_p_value(ks: Column, ref_rows: Column, cur_rows: Column) -> Column:
    """Asymptotic p-value: Kolmogorov's series at sqrt(n*m/(n+m)) * ks."""
    x = F.sqrt(ref_rows * cur_rows / (ref_rows + cur_rows)) * ks
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * x * x),
    )
    # Below 0.2 the series needs more terms than it has; the value is 1 to twelve digits there.
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_tests(reference: DataFrame, current: DataFrame, columns: list[str] | None = None, p_limit: float = TEST_P_VALUE) -> DataFrame:
    """column, test, statistic, p_value, drift_detected for the numeric columns."""
    return ks_decisions(ks_statistics(reference, current, columns), p_limit)


def ks_decisions(statistics: DataFrame, p_limit: float = TEST_P_VALUE) -> DataFrame:
    p = ks_p_value(F.col("ks"), F.col("ref_rows").cast("double"), F.col("cur_rows").cast("double"))
    return statistics.select(
        "column", F.lit("ks").alias("test"), F.col("ks").alias("statistic"), p.alias("p_value"), (p < p_limit).alias("drift_detected")
    )


def chi2_statistics(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Chi-square statistic of current category counts against reference shares.

    column, categories, ref_share (reference categories per reference row), chi2. Categories are counted
    map-side, once: the counts are stored. A category the reference lacks makes the statistic infinite.
    Missing categories are left out, as in the numeric test.
    """
    if columns is None:
        columns = [
            f.name for f in reference.schema.fields if isinstance(f.dataType, T.StringType) and f.name in current.columns
        ]
    if not columns:
        return reference.sparkSession.createDataFrame([], _CHI2)
    both = _both(reference, current, columns)
    counted = category_cells(both, columns).groupBy("column", "value")
    return chi2_from_counts(counted.agg(F.count_if(F.col("_is_ref")).alias("n_ref"), F.count_if(~F.col("_is_ref")).alias("n_cur")))


def category_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """_is_ref, column, value: the present values of the text columns, one row each."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    )
    return df.select("_is_ref", F.explode(cells).alias("c")).select("_is_ref", "c.*").where("value is not null")


def chi2_from_counts(counts: DataFrame) -> DataFrame:
    """The statistics from column, value, n_ref, n_cur."""
    counts = to_scratch_table(counts, "categories")
    # One row per compared column.
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("ref_rows"), F.sum("n_cur").alias("cur_rows"))
    expected = F.col("n_ref") / F.col("ref_rows") * F.col("cur_rows")
    cell = F.when(F.col("n_ref") == 0, F.lit("Infinity").cast("double")).otherwise(
        (F.col("n_cur") - expected) * (F.col("n_cur") - expected) / expected
    )
    return (
        counts.join(F.broadcast(totals.where("ref_rows > 0 and cur_rows > 0")), "column")
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("categories"),
            (F.count_if(F.col("n_ref") > 0) / F.sum("n_ref")).alias("ref_share"),
            F.sum(cell).alias("chi2"),
        )
    )


@F.pandas_udf(T.DoubleType())
def chi2_p_value(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution; one value per compared column."""
    return pd.Series([_chi2_tail(x, int(k)) for x, k in zip(statistic, freedom)], dtype="float64")


def _chi2_tail(x: float, freedom: int) -> float:
    """Upper incomplete gamma function: its power series below the mean, its continued fraction above.

    Either converges in a number of steps that grows with the root of the degrees of freedom.
    """
    if freedom <= 0 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    shape, half = freedom / 2, x / 2
    front = math.exp(shape * math.log(half) - half - math.lgamma(shape))
    if half < shape + 1:
        term = total = 1 / shape
        n = shape
        while term > total * 1e-17:
            n += 1
            term *= half / n
            total += term
        return min(1.0, max(0.0, 1 - front * total))
    # Convergents p/q of 1/(h+1-s - 1(1-s)/(h+3-s - 2(2-s)/(h+5-s - ...))), kept as their ratio steps.
    b = half + 1 - shape
    value, numerator, denominator = 1 / b, math.inf, 1 / b
    n = 0
    while True:
        n += 1
        a = n * (shape - n)
        b += 2
        denominator = 1 / (b + a * denominator)
        numerator = b + a / numerator
        step = numerator * denominator
        value *= step
        if abs(step - 1) < 1e-15:
            return min(1.0, max(0.0, front * value))


def chi2_tests(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    p_limit: float = TEST_P_VALUE,
    most_share: float | None = None,
) -> DataFrame:
    """column, test, statistic, p_value, drift_detected for the text columns.

    With `most_share`, columns with more categories per reference row are listed as not tested: their p-value
    and decision are null.
    """
    return chi2_decisions(chi2_statistics(reference, current, columns), p_limit, most_share)


def chi2_decisions(statistics: DataFrame, p_limit: float = TEST_P_VALUE, most_share: float | None = None) -> DataFrame:
    scored = statistics.withColumn("p_value", chi2_p_value(F.col("chi2"), F.col("categories") - 1))
    if most_share is not None:
        scored = scored.withColumn("p_value", F.when(F.col("ref_share") <= most_share, F.col("p_value")))
    return scored.select(
        "column",
        F.lit("chi2").alias("test"),
        F.col("chi2").alias("statistic"),
        "p_value",
        (F.col("p_value") < p_limit).alias("drift_detected"),
    )


def report_from_tests(tests: DataFrame, drift_share: float = TEST_DRIFT_SHARE) -> DataFrame:
    """Report over per-column tests; details hold the p-values, null for columns that were not tested.

    The score is the share of the tested columns; where columns are there but none was tested, score and
    decision are null rather than "no drift".
    """
    hit = F.col("drift_detected")
    none_tested = (F.count("drift_detected") == 0) & (F.count(F.lit(1)) > 0)
    share = F.when(~none_tested, F.count_if(hit) / F.greatest(F.count("drift_detected"), F.lit(1)))
    return tests.agg(
        share.alias("drift_score"),
        F.array_sort(F.collect_list(F.when(hit, F.col("column")))).alias("drifted_columns"),
        F.map_from_entries(F.collect_list(F.struct("column", "p_value"))).alias("details"),
    ).select(
        F.current_timestamp().alias("timestamp"),
        (F.col("drift_score") >= drift_share).alias("dataset_drift"),
        "drift_score",
        "drifted_columns",
        "details",
    )


def check_drift(reference: DataFrame, current: DataFrame, method: str = "tests", **psi_options) -> DataFrame:
    """Drift report by two-sample tests, or by the stability index when asked or when no column can be tested.

    Text columns of ids or free text (CATEGORY_SHARE) are listed as not tested: new values are no drift
    there. Name such columns in `chi2_tests` to test them all the same. Without comparable columns nothing drifts.
    """
    if method == "tests":
        numeric = shared_numeric_columns(reference, current)
        text = [f.name for f in reference.schema.fields if isinstance(f.dataType, T.StringType) and f.name in current.columns]
        parts = ([ks_tests(reference, current, numeric)] if numeric else []) + ([chi2_tests(reference, current, text, most_share=CATEGORY_SHARE)] if text else [])
        if parts:
            return report_from_tests(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))
        warnings.warn("no column to test; using the stability index", stacklevel=2)
    return drift_report(psi_scores(reference, current), **psi_options)


# ---- retraining ---------------------------------------------------------------------------------


def retrain_decision(
    report: DataFrame,
    feedback_rows: Column | int,
    min_score: float = RETRAIN_SCORE,
    min_feedback: int = RETRAIN_FEEDBACK,
) -> DataFrame:
    """should_retrain and reason; drift is looked at before the feedback volume.

    `feedback_rows` is a number or a scalar subquery (`counted.scalar()`).
    """
    rows = F.lit(feedback_rows) if isinstance(feedback_rows, int) else feedback_rows
    seen = report.select(
        F.coalesce("dataset_drift", F.lit(False)).alias("dataset_drift"),
        F.coalesce("drift_score", double_lit(0.0)).alias("drift_score"),
        rows.alias("feedback_rows"),
    )
    score = F.format_string("%.3f", F.col("drift_score"))
    count = F.col("feedback_rows").cast("string")
    by_drift = F.col("dataset_drift") & (F.col("drift_score") >= double_lit(min_score))
    by_feedback = F.col("feedback_rows") >= min_feedback
    reason = (
        F.when(by_drift, F.concat(F.lit("Dataset drift detected (score="), score, F.lit(")")))
        .when(by_feedback, F.concat(F.lit("Feedback threshold reached ("), count, F.lit(" samples)")))
        .otherwise(F.concat(F.lit("No trigger (drift="), score, F.lit(", feedback="), count, F.lit(")")))
    )
    return seen.select((by_drift | by_feedback).alias("should_retrain"), reason.alias("reason"))
