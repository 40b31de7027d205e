"""Validation and payload flattening."""

from __future__ import annotations

import re
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sluiceway.functions.columns import quoted


def validate(df: DataFrame) -> DataFrame:
    """Keep one of each fully identical row, then drop rows in which every column is missing.

    Identical rows are combined before the shuffle, so a hot group of copies travels as one row per
    task. NaN counts as missing.
    """
    return df.dropDuplicates().na.drop(how="all")


def validate_counted(df: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """`validate` with row counts before and after, gathered while the result is computed.

    Read `observation.get["rows"]` after an action on the returned frame.
    """
    before, after = Observation(), Observation()
    seen = df.observe(before, F.count(F.lit(1)).alias("rows"))
    return validate(seen).observe(after, F.count(F.lit(1)).alias("rows")), before, after


def validation_report(df: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows removed."""
    return (
        df.groupBy(*[quoted(c) for c in df.columns])
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.sum("_n").alias("rows_before"),
            F.count_if(~_all_missing(df.schema)).alias("rows_after"),
        )
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def _all_missing(schema: T.StructType) -> Column:
    missing = F.lit(True)
    for f in schema.fields:
        c = quoted(f.name)
        gone = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c.isNull()
        missing = missing & gone
    return missing


# ---- payload flattening -------------------------------------------------------------------------


def infer_payload_schema(df: DataFrame, payload: str = "payload") -> T.StructType:
    """Schema that covers every JSON object in the column, merged by a distributed aggregate.

    Keys are told apart by case. Keys of one object that differ only in case raise: as columns one of
    them would take the other's values.
    """
    is_object = quoted(payload).rlike(r"^\s*\{")
    parsed = F.try_parse_json(F.when(is_object, quoted(payload)))
    with case_sensitive(df.sparkSession):
        found = df.agg(F.schema_of_variant_agg(parsed).alias("s")).first().s or ""
    # Fixed form: the aggregate spells structs OBJECT<...>; field names may be quoted by back-ticks.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    if not ddl.startswith("STRUCT<"):
        return T.StructType([])
    schema = _plain(T.DataType.fromDDL(ddl))
    _refuse_case_clash(schema, "")
    return schema


@contextmanager
def case_sensitive(spark: SparkSession):
    """The session with case-sensitive names; the setting before is restored."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def _refuse_case_clash(kind: T.DataType, path: str) -> None:
    if isinstance(kind, T.ArrayType):
        _refuse_case_clash(kind.elementType, path)
    if isinstance(kind, T.StructType):
        names = [f.name for f in kind.fields]
        folded = Counter(n.lower() for n in names)
        clash = sorted(path + n for n in names if folded[n.lower()] > 1)
        if clash:
            raise ValueError(f"payload keys {clash} differ only in case; rename them or give a schema")
        for f in kind.fields:
            _refuse_case_clash(f.dataType, f"{path}{f.name}.")


def _plain(kind: T.DataType) -> T.DataType:
    """JSON numbers written with a fraction become DOUBLE (3.0 too), empty and mixed types STRING."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind


def flatten_payload(df: DataFrame, payload: str = "payload", schema: T.StructType | None = None) -> DataFrame:
    """Replace the JSON payload with one column per leaf: nested keys are dotted, lists kept.

    A plain projection of the same row. Without a schema one pass over the payload infers it.
    """
    if payload not in df.columns:
        return df
    schema = schema or infer_payload_schema(df, payload)
    kept = [quoted(c) for c in df.columns if c != payload]
    if not schema.fields:
        return df.select(*kept)
    parsed = df.withColumn("_p", F.from_json(quoted(payload), schema))
    leaves: dict[str, Column] = {}
    for name, column in _leaves(schema, F.col("_p"), ""):
        # {"a": {"b": 1}} and {"a.b": 1} both mean a.b; the nested one wins.
        leaves[name] = F.coalesce(column, leaves[name]) if name in leaves else column
    clash = sorted(set(leaves) & {c for c in df.columns if c != payload})
    if clash:
        raise ValueError(f"payload keys {clash} are already columns; rename the columns first")
    return parsed.select(*kept, *[c.alias(name) for name, c in leaves.items()])


def _leaves(schema: T.StructType, at: Column, path: str):
    nested_last = sorted(schema.fields, key=lambda f: isinstance(f.dataType, T.StructType))
    for f in nested_last:
        here = at.getField(f.name)
        name = f"{path}{f.name}"
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, here, f"{name}.")
        else:
            yield name, here
