"""Sources, envelope, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import table
from sluiceway.functions.clock import from_epoch_ms
from sluiceway.operators.clean import flatten_payload, validate, validation_report
from sluiceway.operators.requests import record_problem
from sluiceway.operators.sinks import land_jsonl, materialise
from sluiceway.session import scratch_path
from sluiceway.sources.envelope import to_raw_envelope
from sluiceway.sources.files import load_raw, load_raw_records, scan_batch
from sluiceway.sources.paged_api import PER_PAGE, unpack_pages
from sluiceway.sources.topic_ledger import OffsetLedger, land_new_messages


def raw_envelope_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = scan_batch(spark, f"{sf_dir}/orders.parquet", id_col="o_orderkey")
    row = F.from_json(
        "payload", "o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    )
    return records.withColumn("row", row).select(
        "id",
        F.regexp_extract("source", "orders[.]parquet", 0).alias("source"),
        "schema_version",
        "row.o_custkey",
        "row.o_orderstatus",
        "row.o_totalprice",
        F.col("row.o_orderdate").cast("date").cast("string").alias("o_orderdate"),
        "row.o_orderpriority",
    )


def raw_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON lines and suppliers as Parquet below one path, loaded together."""
    base = scratch_path(spark, "raw")
    customers = table(spark, sf_dir, "customer").toDF("key", "name", "nation", "balance", "segment")
    suppliers = table(spark, sf_dir, "supplier").toDF("key", "name", "nation", "balance")
    customers.write.json(f"{base}/customers")
    suppliers.write.parquet(f"{base}/suppliers")
    return load_raw(spark, base).select("key", "name", F.col("nation").cast("bigint").alias("nation"), "balance", "segment")


def land_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land envelopes as JSON lines, read them back, compare the counted and the loaded rows."""
    base = scratch_path(spark, "raw")
    landed = land_jsonl(to_raw_envelope(table(spark, sf_dir, "supplier"), "s_suppkey"), f"{base}/suppliers")
    row = F.from_json("payload", "s_name string, s_nationkey bigint, s_acctbal double")
    return load_raw_records(spark, base).select(
        "id", "schema_version", row.alias("row"), F.lit(landed).cast("bigint").alias("landed")
    ).select("id", "schema_version", "row.*", "landed")


def _pages(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """page, found: the customers of each page of 100 keys."""
    item = F.struct(F.col("c_custkey").alias("id"), *fields)
    page = F.floor(F.col("c_custkey") / PER_PAGE).alias("page")
    return table(spark, sf_dir, "customer").groupBy(page).agg(F.collect_list(item).alias("found"))


def page_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON pages of up to 100 items, under either of the two list names."""
    pages = _pages(spark, sf_dir, "c_name", "c_acctbal")
    body = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.col("found").alias("items")))).otherwise(
        F.to_json(F.struct(F.col("found").alias("results")))
    )
    row = F.from_json("item", "id bigint, c_name string, c_acctbal double")
    return unpack_pages(pages.select("page", body.alias("body"))).select("page", row.alias("r")).select("page", "r.*")


def validate_dedupe_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(table(spark, sf_dir, "documents").select("text", "lang"))


def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_report(table(spark, sf_dir, "documents").select("text", "lang"))


def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"))
    return flatten_payload(events)


def materialise_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write flattened events as one split and read it back."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("props").alias("payload"))
    return spark.read.parquet(materialise(events, scratch_path(spark, "features"), "train"))


def record_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows judged by the required fields; some events are made to miss one."""
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("id"),
        F.when(F.col("event_type") != "signup", F.lit("events")).alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "click", F.lit("[1, 2]")).otherwise(F.col("props")).alias("payload"),
    )
    return records.select("event_id", F.coalesce(record_problem(), F.lit("none")).alias("problem"))


def epoch_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.expr("unix_millis(cast(ts as timestamp))")
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(from_epoch_ms(ms), "yyyy-MM-dd HH:mm:ss.SSS").alias("at")
    )


def topic_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a topic of four partitions, landed by three runs of one group whose reads overlap."""
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").cast("bigint").alias("offset"),
        F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp"),
    )
    high = events.agg(F.max("offset")).first()[0] or 0
    base = scratch_path(spark, "topic")
    ledger = OffsetLedger(spark, f"{base}/ledger", "features")
    for low, upto in ((0, high // 3), (high // 6, 2 * high // 3), (0, high)):
        land_new_messages(events.where(F.col("offset").between(low, upto)), ledger, f"{base}/raw")
    landed = spark.read.parquet(f"{base}/raw").groupBy("run", F.get(F.split("source", ":"), F.lit(2)).cast("int").alias("partition"))
    counted = landed.agg(F.count(F.lit(1)).alias("landed"), F.countDistinct("source").alias("sources"))
    return ledger.entries().join(counted, ["run", "partition"]).select("run", "partition", "start", "until", "rows", "missing", "landed", "sources")


QUERIES = {
    "topic_batches": topic_batches,
    "raw_envelope_batch": raw_envelope_batch,
    "raw_union_by_name": raw_union_by_name,
    "land_and_load": land_and_load,
    "page_unpack": page_unpack,
    "validate_dedupe_nulls": validate_dedupe_nulls,
    "validation_counts": validation_counts,
    "flatten_payload": flatten_events,
    "materialise_split": materialise_split,
    "record_conformance": record_conformance,
    "epoch_timestamps": epoch_timestamps,
}

ORACLES = {
    "topic_batches": """
        WITH e AS (SELECT (user_id % 4)::INTEGER AS p, event_id AS o, max(event_id) OVER () AS high FROM events),
        b AS (SELECT p, o, CASE WHEN o <= high // 3 THEN 0 WHEN o <= 2 * high // 3 THEN 1 ELSE 2 END AS run FROM e),
        g AS (SELECT run, p, min(o) AS least, max(o) + 1 AS ends, count(*) AS n FROM b GROUP BY run, p),
        s AS (SELECT *, coalesce(lag(ends) OVER (PARTITION BY p ORDER BY run), least) AS begins FROM g)
        SELECT run, p AS "partition", begins AS "start", ends AS "until", n AS "rows", ends - begins - n AS missing, n AS landed, n AS sources FROM s""",
    "raw_envelope_batch": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, 'orders.parquet' AS source, '1.0' AS schema_version, o_custkey,
               o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
        FROM orders""",
    "raw_union_by_name": """
        SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance,
               c_mktsegment AS segment FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal, NULL FROM supplier""",
    "land_and_load": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id, '1.0' AS schema_version, s_name,
               CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal, (SELECT count(*) FROM supplier) AS landed
        FROM supplier""",
    "page_unpack": """
        SELECT CAST(c_custkey // 100 AS BIGINT) AS page, c_custkey AS id, c_name, c_acctbal FROM customer""",
    "validate_dedupe_nulls": """
        SELECT DISTINCT text, lang FROM documents WHERE text IS NOT NULL OR lang IS NOT NULL""",
    "validation_counts": """
        WITH kept AS (SELECT DISTINCT text, lang FROM documents WHERE text IS NOT NULL OR lang IS NOT NULL)
        SELECT n AS rows_before, k AS rows_after, n - k AS rows_removed
        FROM (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM kept) AS k)""",
    "flatten_payload": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "materialise_split": """
        SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "record_conformance": """
        SELECT event_id, CASE event_type WHEN 'error' THEN 'id' WHEN 'signup' THEN 'source'
                         WHEN 'click' THEN 'payload' ELSE 'none' END AS problem
        FROM events""",
    "epoch_timestamps": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS "at" FROM events""",
}
