"""Feature engineering, fitted transformers and feature rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.functions import clock, text
from sluiceway.functions.columns import category_text, double_lit, quoted, row_json, valid_double
from sluiceway.operators.ranking import exact_positions
from sluiceway.schemas import scalar_columns, timestamp_columns
from sluiceway.session import to_scratch_table

# Up to this many classes are ranked by one window; more go through the range-partitioned rank.
SMALL_VOCABULARY = 100_000


def add_text_features(df: DataFrame, column: str = "text") -> DataFrame:
    """text_len and word_count; a table without the column is returned as it is."""
    if column not in df.columns:
        return df
    return df.withColumns(
        {"text_len": text.text_length(quoted(column)), "word_count": text.word_count(quoted(column))}
    )


def add_time_features(df: DataFrame) -> DataFrame:
    """Hour, weekday (Monday = 0) and month of every timestamp column."""
    added: dict[str, Column] = {}
    for c in timestamp_columns(df.schema):
        added[f"{c}_hour"] = clock.hour_of(quoted(c))
        added[f"{c}_dayofweek"] = clock.weekday_of(quoted(c))
        added[f"{c}_month"] = clock.month_of(quoted(c))
    return df.withColumns(added) if added else df


def engineer(df: DataFrame) -> DataFrame:
    return add_time_features(add_text_features(df))


def to_feature_rows(df: DataFrame, entity_col: str = "id") -> DataFrame:
    """entity_id, the other scalar columns as one JSON object (nulls left out), event_timestamp."""
    entity = quoted(entity_col).cast("string") if entity_col in df.columns else F.lit("unknown")
    values = [c for c in scalar_columns(df.schema) if c != entity_col]
    packed = row_json(values) if values else F.lit("{}")
    return df.select(
        entity.alias("entity_id"), packed.alias("feature_values"), F.current_timestamp().alias("event_timestamp")
    )


@dataclass(frozen=True)
class ScalerState:
    """Fitted numbers of one numeric column."""

    mean: float | None
    std: float | None
    min: float | None
    max: float | None

    def apply(self, method: str, value: Column) -> Column:
        if method == "standard":
            spread = 1.0 if not self.std or self.min == self.max else self.std
            return (value - double_lit(self.mean)) / double_lit(spread)
        width = (self.max - self.min) or 1.0
        return (value - double_lit(self.min)) / double_lit(width)


class FeatureTransformer:
    """Scalers, encoders and custom steps: fitted on one frame, applied to any.

    The fitted state is small: four numbers per scaled column, and one mapping table
    (value, code) per encoded column, kept in the shared folder.
    """

    def __init__(self, handle_unseen: str = "error") -> None:
        if handle_unseen not in ("error", "keep"):
            raise ValueError("handle_unseen must be 'error' or 'keep'")
        self.handle_unseen = handle_unseen
        self._scalers: dict[str, str] = {}
        self._encoders: list[str] = []
        self._custom: list[tuple[str, Callable[[DataFrame], DataFrame]]] = []
        self._scaler_state: dict[str, ScalerState] = {}
        self._mappings: dict[str, DataFrame] = {}

    def add_scaler(self, col: str, method: str = "standard") -> FeatureTransformer:
        """Standard scaling; any other method name means min-max."""
        self._scalers[col] = method
        return self

    def add_encoder(self, col: str) -> FeatureTransformer:
        if col not in self._encoders:
            self._encoders.append(col)
        return self

    def add_custom(self, name: str, fn: Callable[[DataFrame], DataFrame]) -> FeatureTransformer:
        self._custom.append((name, fn))
        return self

    def fit(self, df: DataFrame) -> FeatureTransformer:
        """One aggregate for all scalers, one distinct per encoder; absent columns are skipped."""
        scaled = [c for c in self._scalers if c in df.columns]
        if scaled:
            aggs = []
            for i, c in enumerate(scaled):
                v = valid_double(c)
                aggs += [F.avg(v), F.stddev_pop(v), F.min(v), F.max(v)]
            row = list(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first())
            for i, c in enumerate(scaled):
                state = ScalerState(*row[4 * i : 4 * i + 4])
                if state.mean is None:
                    raise ValueError(f"column {c} has no values to fit a scaler on")
                self._scaler_state[c] = state
        for c in self._encoders:
            if c in df.columns:
                self._mappings[c] = label_codes(df, c)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        scaled: dict[str, Column] = {}
        for c, method in self._scalers.items():
            if c in df.columns:
                if c not in self._scaler_state:
                    raise RuntimeError(f"scaler of column {c} is not fitted")
                scaled[c] = self._scaler_state[c].apply(method, quoted(c).cast("double"))
        out = df.withColumns(scaled) if scaled else df
        for c in self._encoders:
            if c in out.columns:
                if c not in self._mappings:
                    raise RuntimeError(f"encoder of column {c} is not fitted")
                out = encode_labels(out, c, self._mappings[c], self.handle_unseen)
        for _, fn in self._custom:
            out = out.transform(fn)
        return out

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def scaler_table(self, spark) -> DataFrame:
        """The fitted numbers as a table."""
        rows = [(c, self._scalers[c], s.mean, s.std, s.min, s.max) for c, s in self._scaler_state.items()]
        return spark.createDataFrame(rows, "column string, kind string, mean double, std double, min double, max double")

    def label_table(self, col: str) -> DataFrame:
        """The fitted mapping of an encoded column: value, code."""
        return self._mappings[col]


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """Code of each distinct value: its rank among the sorted values, from 0.

    The distinct values are combined map-side, so a hot value costs one row per task. They are
    stored once; a vocabulary too large for one task is ranked by ranges.
    """
    kind = df.schema[col].dataType.typeName()
    distinct = df.select(category_text(kind, quoted(col)).alias("value")).distinct()
    stored = to_scratch_table(distinct, "vocabulary")
    if stored.count() <= SMALL_VOCABULARY:
        code = F.row_number().over(Window.orderBy("value")) - 1
        return stored.withColumn("code", code.cast("bigint"))
    return exact_positions(stored, [], ["value"], "code")


def encode_labels(df: DataFrame, col: str, codes: DataFrame, handle_unseen: str = "error") -> DataFrame:
    """Replace a column by its code.

    A left join whose strategy is left to Spark: it broadcasts the stored mapping while its measured
    size allows, else it shuffles, with hot values split by the adaptive skew handling.
    """
    kind = df.schema[col].dataType.typeName()
    value = category_text(kind, quoted(col))
    known = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    if handle_unseen == "keep":
        code = F.coalesce(F.col("_code"), F.lit(-1).cast("bigint"))
    else:
        problem = F.raise_error(F.concat(F.lit(f"unseen value in column {col}: "), value))
        code = F.coalesce(F.col("_code"), problem.cast("bigint"))
    columns = [code.alias(c) if c == col else quoted(c) for c in df.columns]
    return df.join(known, value == F.col("_value"), "left").select(*columns)
