"""Validation and defaulting of service requests, feedback and raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.schemas import FEEDBACK_RECORD

# Fixed values of the request contracts.
MAX_INPUTS = 64
MAX_QUERY_CHARS = 2000
TOP_K_RANGE = (1, 20)
DEFAULT_TOP_K = 5
TEMPERATURE_RANGE = (0.0, 2.0)
DEFAULT_TEMPERATURE = 0.2
DEFAULT_MODEL_VERSION = "champion"


def check_predict_requests(requests: DataFrame, inputs: str = "inputs") -> DataFrame:
    """Add `valid`: between 1 and 64 inputs; fill in the model version."""
    version = F.col("model_version") if "model_version" in requests.columns else F.lit(None).cast("string")
    count = F.coalesce(F.size(F.col(inputs)), F.lit(0))
    return requests.withColumns(
        {
            "model_version": F.coalesce(version, F.lit(DEFAULT_MODEL_VERSION)),
            "valid": count.between(1, MAX_INPUTS) & F.coalesce(~F.exists(F.col(inputs), lambda x: x.isNull()), F.lit(False)),
        }
    )


def explode_inputs(requests: DataFrame, inputs: str = "inputs") -> DataFrame:
    """One row per input of a request, with its position, for batch scoring."""
    others = [c for c in requests.columns if c != inputs]
    return requests.select(*others, F.posexplode(inputs).alias("position", "text"))


def check_retrieval_requests(requests: DataFrame) -> DataFrame:
    """Fill in top_k and temperature, add `valid` and `problem` (the first broken rule)."""

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in requests.columns else F.lit(None).cast(kind)

    filled = requests.withColumns(
        {
            "top_k": F.coalesce(given("top_k", "int"), F.lit(DEFAULT_TOP_K)),
            "temperature": F.coalesce(given("temperature", "double"), F.lit(DEFAULT_TEMPERATURE)),
        }
    )
    length = F.coalesce(F.length("query"), F.lit(0))
    problem = (
        F.when(~length.between(1, MAX_QUERY_CHARS), "query")
        .when(~F.col("top_k").between(*TOP_K_RANGE), "top_k")
        .when(~F.col("temperature").between(*TEMPERATURE_RANGE), "temperature")
    )
    return filled.withColumn("problem", problem).withColumn("valid", F.col("problem").isNull())


def feedback_records(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Feedback rows from JSON bodies: unknown prediction ids, source and time are filled in.

    Bodies that are no JSON object (malformed, null) are no feedback and give no row.
    """
    fields = "prediction_id string, true_label string, predicted_label string, source string"
    b = F.from_json(F.col(body), fields)
    columns = {
        "prediction_id": F.coalesce(b["prediction_id"], F.lit("unknown")),
        "true_label": b["true_label"],
        "predicted_label": b["predicted_label"],
        "timestamp": F.current_timestamp(),
        "source": F.coalesce(b["source"], F.lit("api")),
    }
    is_object = F.col(body).rlike(r"^\s*\{") & F.try_parse_json(body).isNotNull()
    return bodies.where(is_object).select(*[columns[f.name].alias(f.name) for f in FEEDBACK_RECORD.fields])


def record_problem() -> Column:
    """The first missing required field of an envelope row; null for a good row."""
    is_object = F.col("payload").rlike(r"^\s*\{") & F.try_parse_json("payload").isNotNull()
    return (
        F.when(F.col("id").isNull(), "id")
        .when(F.col("source").isNull(), "source")
        .when(F.col("timestamp").isNull(), "timestamp")
        .when(~F.coalesce(is_object, F.lit(False)), "payload")
    )


def quarantine_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good envelope rows, and the others with the field that is wrong."""
    judged = records.withColumn("problem", record_problem())
    return judged.where("problem is null").drop("problem"), judged.where("problem is not null")
