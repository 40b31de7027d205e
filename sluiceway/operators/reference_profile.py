"""A stored profile of the reference: drift runs against it scan the current table alone.

The profile holds each column's distinct values with their counts. Counts of equal values add up, so profiles of
parts (days, regions) merge into the profile of the whole without their tables. Beside the values lie row counts
per bin for the stability index and for the Kolmogorov-Smirnov test. The values themselves are only ranked in
bins that can hold the largest distance. Results equal those of
`sluiceway.operators.drift` on the two tables.

Tables below the profile's folder: `numbers` (column, bin, v, n), `ks_bins`, `psi_bins` (column, bin, n),
`categories` (column, value, n), and `columns`, written last: a folder without it is no finished profile.
Missing values and NaN count nowhere; a column without values has no rows in the other tables.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluiceway.functions.columns import quoted, valid_double
from sluiceway.operators import drift
from sluiceway.operators.ranking import finite_double, long_values
from sluiceway.schemas import numeric_columns
from sluiceway.session import to_scratch_table

_COLUMNS = "position int, column string, kind string, splits array<double>, low double, high double, rows bigint"
_NUMBERS = "column string, bin bigint, v double, n bigint"
_BINS = "column string, bin bigint, n bigint"
_CATEGORIES = "column string, value string, n bigint"


def _text_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def store_profile(reference: DataFrame, path: str, columns: list[str] | None = None) -> ReferenceProfile:
    """Profile the numeric and text columns (or the named ones of them) into an empty folder: one scan for each kind."""
    wanted = lambda names: [c for c in names if columns is None or c in columns]
    numeric, text = wanted(numeric_columns(reference.schema)), wanted(_text_columns(reference.schema))
    spark = reference.sparkSession
    numbers = spark.createDataFrame([], "column string, v double, n bigint, infinite bigint")
    if numeric:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), finite_double(c).alias("v"), valid_double(c).alias("x")) for c in numeric])
        cells = reference.select(F.explode(cells).alias("c")).select("c.*").where("v is not null")
        # An infinite value is kept as the largest finite one, as in the two-sample test, and counted apart.
        numbers = cells.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") != F.col("x")).alias("infinite"))
    categories = spark.createDataFrame([], _CATEGORIES)
    if text:
        cells = drift.category_cells(reference.select(F.lit(True).alias("_is_ref"), *map(quoted, text)), text)
        categories = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [c for c in reference.columns if c in numeric or c in text]
    return _write(spark, path, numbers, categories, [(c, "number" if c in numeric else "text") for c in order])


def merge_profiles(profiles: list[ReferenceProfile], path: str) -> ReferenceProfile:
    """The profile of all rows of several profiles with the same columns."""
    kinds = [[(r.column, r.kind) for r in p.columns()] for p in profiles]
    if any(k != kinds[0] for k in kinds):
        raise ValueError("profiles of different columns cannot be merged")
    spark = profiles[0].spark
    numbers, categories = None, None
    for p in profiles:
        more, texts = p.raw_numbers(), p.table("categories", _CATEGORIES)
        numbers = more if numbers is None else numbers.unionByName(more)
        categories = texts if categories is None else categories.unionByName(texts)
    numbers = numbers.groupBy("column", "v").agg(F.sum("n").alias("n"), F.sum("infinite").alias("infinite"))
    return _write(spark, path, numbers, categories.groupBy("column", "value").agg(F.sum("n").alias("n")), kinds[0])


def _write(spark: SparkSession, path: str, numbers: DataFrame, categories: DataFrame, kinds: list[tuple[str, str]]) -> ReferenceProfile:
    categories.write.parquet(f"{path}/categories")
    numbers = to_scratch_table(numbers, "profile-numbers")
    shares = F.array(*[F.lit(k / drift.KS_BINS) for k in range(1, drift.KS_BINS)])
    infinite = F.max(F.col("infinite") > 0)
    # One row per column: its cuts, extremes and number of rows.
    found = numbers.groupBy("column").agg(
        F.percentile_approx("v", shares, F.lit(8 * drift.KS_BINS)).alias("cuts"),
        F.when(infinite, F.lit(-math.inf)).otherwise(F.min("v")).alias("low"),
        F.when(infinite, F.lit(math.inf)).otherwise(F.max("v")).alias("high"),
        F.sum("n").alias("rows"),
    )
    found = {r["column"]: r for r in found.collect()}
    placed, rows = None, []
    for position, (c, kind) in enumerate(kinds):
        if c not in found:
            rows.append((position, c, kind, drift.ks_splits([]) if kind == "number" else None, None, None, 0))
            continue
        splits = drift.ks_splits(found[c].cuts)
        rows.append((position, c, kind, splits, found[c].low, found[c].high, found[c].rows))
        own = Bucketizer(splits=splits, inputCol="v", outputCol="bin").transform(numbers.where(F.col("column") == c))
        own = own.select("column", F.col("bin").cast("bigint").alias("bin"), "v", "n", "infinite")
        placed = own if placed is None else placed.unionByName(own)
    if placed is None:
        placed = spark.createDataFrame([], _NUMBERS + ", infinite bigint")
    placed.repartitionByRange("column", "bin", "v").sortWithinPartitions("column", "bin", "v").write.parquet(f"{path}/numbers")
    profile = ReferenceProfile(spark, path)
    profile.table("numbers", _NUMBERS).groupBy("column", "bin").agg(F.sum("n").alias("n")).coalesce(1).write.parquet(f"{path}/ks_bins")
    meta = spark.createDataFrame(rows, _COLUMNS)
    psi = profile.psi_counts(meta.where("kind = 'number' and low < high").select("column", "low", "high"), drift.PSI_BUCKETS)
    psi.coalesce(1).write.parquet(f"{path}/psi_bins")
    meta.coalesce(1).write.parquet(f"{path}/columns")
    return profile


class ReferenceProfile:
    """Drift of current tables against the profile in a folder. Columns that a table lacks are left out."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def raw_numbers(self) -> DataFrame:
        return self.table("numbers", _NUMBERS + ", infinite bigint").drop("bin")

    def columns(self) -> list:
        return self.table("columns", _COLUMNS).orderBy("position").collect()

    def _shared(self, current: DataFrame, kind: str, columns: list[str] | None) -> list:
        return [r for r in self.columns() if r.kind == kind and r.column in current.columns and (columns is None or r.column in columns)]

    def _numbered(self, stored: DataFrame, names: list[str]) -> DataFrame:
        """Rows of the named columns with their number r."""
        numbers = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(i))])
        return stored.where(F.col("column").isin(names)).withColumn("r", F.element_at(numbers, F.col("column")))

    def psi_counts(self, spans: DataFrame, buckets: int) -> DataFrame:
        """column, bin, n: reference rows per equal-width bin, from the stored values. spans: column, low, high."""
        # One row per column.
        values = self.table("numbers", _NUMBERS).drop("bin").join(F.broadcast(spans), "column")
        return values.groupBy("column", drift.psi_place(buckets).cast("bigint").alias("bin")).agg(F.sum("n").alias("n"))

    def psi_bins(self, current: DataFrame, columns: list[str] | None = None, buckets: int = drift.PSI_BUCKETS) -> DataFrame:
        """As `drift.psi_bins`."""
        known = self._shared(current, "number", columns)
        if not known:
            return self.spark.createDataFrame([], drift._PSI_BINS)
        present = current.agg(*[F.count(valid_double(r.column)).alias(f"a{i}") for i, r in enumerate(known)]).first()
        fitted = [drift.psi_range(r.column, r.low, r.high, r.rows, n) for r, n in zip(known, present)]
        usable = [f[0] for f in fitted if f[1] == "ok"]
        if not usable:
            return drift.psi_grid(self.spark, fitted, None, buckets)
        if buckets == drift.PSI_BUCKETS:
            stored = self.table("psi_bins", _BINS)
        else:
            stored = self.psi_counts(self.spark.createDataFrame([(x.column, x.low, x.high) for x in usable], "column string, low double, high double"), buckets)
        zero = F.lit(0).cast("bigint")
        ref = self._numbered(stored, [x.column for x in usable]).select("r", "bin", F.col("n").alias("n_ref"), zero.alias("n_cur"))
        cur = long_values(current, usable).groupBy("r", drift.psi_place(buckets).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n_cur"))
        both = ref.unionByName(cur.withColumn("n_ref", zero)).groupBy("r", "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
        return drift.psi_grid(self.spark, fitted, both, buckets)

    def psi_scores(self, current: DataFrame, columns: list[str] | None = None, buckets: int = drift.PSI_BUCKETS, floor_actual: bool = False) -> DataFrame:
        """As `drift.psi_scores`."""
        return drift.psi_from_bins(self.psi_bins(current, columns, buckets), floor_actual)

    def ks_statistics(self, current: DataFrame, columns: list[str] | None = None, window_rows: int = drift.KS_WINDOW_ROWS) -> DataFrame:
        """As `drift.ks_statistics`; stored values count where bins are opened."""
        known = self._shared(current, "number", columns)
        if not known:
            return self.spark.createDataFrame([], drift._KS)
        names = [r.column for r in known]
        wide = current.select(F.lit(False).alias("_is_ref"), *[finite_double(c).alias(f"v{i}") for i, c in enumerate(names)])
        values = drift.ks_values(wide, [list(r.splits) for r in known])
        zero = F.lit(0).cast("bigint")
        seen = values.groupBy("r", "bin").agg(F.sum("n_cur").alias("n_cur")).withColumn("n_ref", zero)
        held = self._numbered(self.table("ks_bins", _BINS), names).select("r", "bin", zero.alias("n_cur"), F.col("n").alias("n_ref"))
        bins = seen.unionByName(held).groupBy("r", "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
        stored = self._numbered(self.table("numbers", _NUMBERS), names).select("r", "bin", "v", F.col("n").alias("n_ref"), zero.alias("n_cur"))
        return drift.ks_from_bins(bins, values.unionByName(stored), names, window_rows)

    def chi2_statistics(self, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """As `drift.chi2_statistics`."""
        names = [r.column for r in self._shared(current, "text", columns)]
        if not names:
            return self.spark.createDataFrame([], drift._CHI2)
        zero = F.lit(0).cast("bigint")
        cells = drift.category_cells(current.select(F.lit(False).alias("_is_ref"), *map(quoted, names)), names)
        seen = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_cur")).withColumn("n_ref", zero)
        held = self.table("categories", _CATEGORIES).where(F.col("column").isin(names))
        counts = seen.unionByName(held.select("column", "value", F.col("n").alias("n_ref"), zero.alias("n_cur")))
        return drift.chi2_from_counts(counts.groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")))

    def tests(self, current: DataFrame, p_limit: float = drift.TEST_P_VALUE) -> DataFrame:
        """Both kinds of two-sample tests, as `drift.check_drift` makes them."""
        numbers = drift.ks_decisions(self.ks_statistics(current), p_limit)
        texts = drift.chi2_decisions(self.chi2_statistics(current), p_limit, drift.CATEGORY_SHARE)
        return numbers.unionByName(texts)

    def check_drift(self, current: DataFrame) -> DataFrame:
        """The drift report of the tests."""
        return drift.report_from_tests(self.tests(current))
