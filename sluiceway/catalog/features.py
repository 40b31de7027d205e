"""Features, splits, fitted transformers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import before_and_after, rounded, table
from sluiceway.functions.text import attention_mask, token_window, words
from sluiceway.operators.features import FeatureTransformer, add_text_features, add_time_features, to_feature_rows
from sluiceway.operators.sinks import land_jsonl
from sluiceway.operators.split import split_counts, with_split
from sluiceway.plans.feature_build import build_features
from sluiceway.session import scratch_path
from sluiceway.sources.envelope import to_raw_envelope

MAX_LENGTH = 16


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_text_features(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_time_features(table(spark, sf_dir, "events").select("event_id", "ts")).drop("ts")


def _scaled(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """Fitted on the line items before the cut-off, applied to the others."""
    wanted = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    fitted_on, applied_to = before_and_after(wanted, "l_shipdate")
    model = FeatureTransformer().add_scaler("l_quantity", method).add_scaler("l_extendedprice", method)
    out = model.fit(fitted_on).transform(applied_to)
    return out.select("l_orderkey", "l_linenumber", rounded("l_quantity"), rounded("l_extendedprice"))


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "standard")


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "minmax")


def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return FeatureTransformer().add_encoder("o_orderpriority").fit_transform(orders)


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(table(spark, sf_dir, "documents"), id_col="doc_id").select("doc_id", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and mean words of each split of the documents."""
    documents = with_split(add_text_features(table(spark, sf_dir, "documents")), id_col="doc_id")
    return split_counts(documents, also=[F.round(F.avg("word_count"), 6).alias("mean_words")])


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_feature_rows(table(spark, sf_dir, "part"), "p_partkey").select("entity_id", "feature_values")


def custom_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    def net_price(df: DataFrame) -> DataFrame:
        return df.withColumn("net_price", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6))

    def doubled(df: DataFrame) -> DataFrame:
        return df.withColumn("twice", F.col("l_quantity") * 2)

    model = FeatureTransformer().add_custom("net_price", net_price).add_custom("doubled", doubled)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return model.fit_transform(lines).select("l_orderkey", "l_linenumber", "net_price", "twice")


def pad_and_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("t"))
    return tokens.select(
        "doc_id",
        F.array_join(token_window(F.col("t"), MAX_LENGTH), " ").alias("tokens"),
        F.array_join(F.transform(attention_mask(F.col("t"), MAX_LENGTH), lambda m: m.cast("string")), "").alias("mask"),
    )


def feature_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the whole feature job: raw zone, flatten, validate, engineer, split, fit, write."""
    base = scratch_path(spark, "build")
    land_jsonl(to_raw_envelope(table(spark, sf_dir, "documents"), "doc_id"), f"{base}/raw")
    model = FeatureTransformer().add_scaler("word_count").add_scaler("text_len", "minmax").add_encoder("lang")
    build_features(spark, f"{base}/raw", f"{base}/features", model, id_col="doc_id")
    out = spark.read.parquet(f"{base}/features")
    return out.select("doc_id", "split", "lang", rounded("word_count"), rounded("text_len"))


QUERIES = {
    "text_features": text_features,
    "time_features": time_features,
    "standard_scale": standard_scale,
    "minmax_scale": minmax_scale,
    "label_encode": label_encode,
    "exact_split": exact_split,
    "split_counts": split_sizes,
    "feature_rows": feature_rows,
    "custom_transform": custom_transform,
    "pad_and_mask": pad_and_mask,
    "feature_build": feature_build,
}

_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"
_SPLIT = """
    shuffled AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS place,
                        count(*) OVER () AS n FROM documents),
    labelled AS (SELECT doc_id, CASE WHEN place <= floor(n * 0.8::DOUBLE) THEN 'train'
                        WHEN place <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val'
                        ELSE 'test' END AS split FROM shuffled)"""
_AFTER = "FROM lineitem, fitted WHERE l_shipdate >= TIMESTAMP '1998-06-01'"

ORACLES = {
    "text_features": f"""
        SELECT doc_id, CAST(length(text) AS INTEGER) AS text_len, CAST(len({_WORDS}) AS INTEGER) AS word_count
        FROM documents""",
    "time_features": """
        SELECT event_id, CAST(hour(ts) AS INTEGER) AS ts_hour, CAST(isodow(ts) - 1 AS INTEGER) AS ts_dayofweek,
               CAST(month(ts) AS INTEGER) AS ts_month FROM events""",
    "standard_scale": f"""
        WITH fitted AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                               stddev_pop(l_extendedprice) AS sp
                        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01')
        SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / CASE WHEN sq = 0 THEN 1 ELSE sq END, 6) AS l_quantity,
               round((l_extendedprice - mp) / CASE WHEN sp = 0 THEN 1 ELSE sp END, 6) AS l_extendedprice {_AFTER}""",
    "minmax_scale": f"""
        WITH fitted AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS p0,
                               max(l_extendedprice) AS p1
                        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01')
        SELECT l_orderkey, l_linenumber,
               round((l_quantity - q0) / CASE WHEN q1 = q0 THEN 1 ELSE q1 - q0 END, 6) AS l_quantity,
               round((l_extendedprice - p0) / CASE WHEN p1 = p0 THEN 1 ELSE p1 - p0 END, 6) AS l_extendedprice {_AFTER}""",
    "label_encode": """
        WITH codes AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
                       FROM (SELECT DISTINCT coalesce(o_orderpriority, 'None') AS value FROM orders))
        SELECT o_orderkey, code AS o_orderpriority
        FROM orders JOIN codes ON codes.value = coalesce(o_orderpriority, 'None')""",
    "exact_split": f"WITH {_SPLIT} SELECT doc_id, split FROM labelled",
    "split_counts": f"""
        WITH {_SPLIT}
        SELECT split, count(*) AS "rows", round(avg(len({_WORDS})), 6) AS mean_words
        FROM labelled JOIN documents USING (doc_id) GROUP BY split""",
    "feature_rows": """
        SELECT CAST(p_partkey AS VARCHAR) AS entity_id,
               CAST(to_json({'p_name': p_name, 'p_brand': p_brand, 'p_type': p_type, 'p_size': p_size,
                             'p_retailprice': p_retailprice}) AS VARCHAR) AS feature_values
        FROM part""",
    "custom_transform": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS net_price,
               l_quantity * 2 AS twice FROM lineitem""",
    "pad_and_mask": f"""
        WITH w AS (SELECT doc_id, {_WORDS} AS t FROM documents)
        SELECT doc_id,
               array_to_string(list_concat(t, list_transform(range(16), lambda i: '[PAD]'))[1:16], ' ') AS tokens,
               rpad(repeat('1', CAST(least(len(t), 16) AS INTEGER)), 16, '0') AS mask
        FROM w""",
    "feature_build": f"""
        WITH {_SPLIT},
        counted AS (SELECT doc_id, split, lang, length(text) AS text_len, len({_WORDS}) AS word_count
                    FROM labelled JOIN documents USING (doc_id)),
        fitted AS (SELECT avg(word_count) AS m, stddev_pop(word_count) AS s, min(text_len) AS lo, max(text_len) AS hi
                   FROM counted WHERE split = 'train'),
        codes AS (SELECT lang AS value, row_number() OVER (ORDER BY lang) - 1 AS code
                  FROM (SELECT DISTINCT lang FROM counted WHERE split = 'train'))
        SELECT doc_id, split, code AS lang, round((word_count - m) / s, 6) AS word_count,
               round((text_len - lo) / (hi - lo), 6) AS text_len
        FROM counted, fitted, codes WHERE codes.value = counted.lang""",
}
