"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CUTOFF = "1998-06-01"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(name: str, digits: int = 6, alias: str | None = None) -> Column:
    """Sums may differ in their last bits between engines and task orders; compare this many digits."""
    return F.round(F.col(name), digits).alias(alias or name)


def before_and_after(df: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Reference rows before the cut-off date, current rows from it on."""
    border = F.lit(CUTOFF).cast("timestamp_ntz")
    return df.where(F.col(date) < border), df.where(F.col(date) >= border)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a request log: value is the latency, an `error` event a failed request."""
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        F.col("event_type").alias("service"),
        F.col("value").alias("latency_ms"),
        failed.alias("error"),
        F.when(failed, "error").otherwise("ok").alias("status"),
    )
