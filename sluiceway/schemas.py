"""Fixed schemas of the tables that the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "1.0"

# Payload is a JSON string: MAP and VARIANT columns cannot be deduplicated by Spark, a string can.
RAW_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)

METRIC_NAMES = ["accuracy", "f1", "precision", "recall", "loss", "auc"]
MODEL_METRICS = T.StructType([T.StructField(name, T.DoubleType()) for name in METRIC_NAMES])

FEEDBACK_RECORD = T.StructType(
    [
        T.StructField("prediction_id", T.StringType()),
        T.StructField("true_label", T.StringType()),
        T.StructField("predicted_label", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)

KAFKA_MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMESTAMP = (T.TimestampType, T.TimestampNTZType)


def numeric_columns(schema: T.StructType) -> list[str]:
    """Integer, float and decimal columns; booleans are not numeric."""
    return [f.name for f in schema.fields if isinstance(f.dataType, _NUMERIC)]


def timestamp_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, _TIMESTAMP)]


def scalar_columns(schema: T.StructType) -> list[str]:
    """Numeric, string and boolean columns."""
    wanted = (*_NUMERIC, T.StringType, T.BooleanType)
    return [f.name for f in schema.fields if isinstance(f.dataType, wanted)]
