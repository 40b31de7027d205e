"""Bounded reads of a topic: what each reader group has read is kept in a ledger, so runs go on where the last one ended.

A run takes each partition from the group's stored end up to the last offset there is, or at most `most` offsets.
Rows are landed in the folder of the run's number, replacing what a broken attempt left there, and the ledger's
entry is written last: every message is landed once however often runs break or overlap. Equal offsets that a
source delivers twice are landed once. Offsets between the borders that never came (compacted or lost) are
counted as missing; a message that comes after its offset was passed is not landed. One run at a time works for a group.

`messages` is any batch table in the layout of Kafka's source; rows without topic, partition or offset have no place
in a topic and are left out. The ledger holds one row per partition and run; no message passes the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.session import to_scratch_table
from sluiceway.sources.kafka import message_records

_ENTRY = "topic string, partition int, start bigint, until bigint, rows bigint, missing bigint"
_PLACE = ["topic", "partition"]


class OffsetLedger:
    """The offsets that a reader group has landed, one folder per run."""

    def __init__(self, spark: SparkSession, path: str, group: str) -> None:
        self.spark, self.path = spark, f"{path}/{group}"

    def entries(self) -> DataFrame:
        """run and its partitions' borders: start (inclusive), until (exclusive), rows landed, offsets missing."""
        schema = f"{_ENTRY}, run int"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def next_run(self) -> int:
        last = self.entries().agg(F.max("run")).first()[0]
        return 0 if last is None else last + 1

    def plan(self, messages: DataFrame, most: int | None = None) -> DataFrame:
        """topic, partition, start, until of the partitions that hold something new."""
        ends = self.entries().groupBy(*_PLACE).agg(F.max("until").alias("next"))
        # One row per partition of the topic.
        new = messages.join(F.broadcast(ends), _PLACE, "left").where("next is null or offset >= next")
        found = new.groupBy(*_PLACE).agg(F.coalesce(F.max("next"), F.min("offset")).alias("start"), (F.max("offset") + 1).alias("until"))
        return found if most is None else found.withColumn("until", F.least("until", F.col("start") + most))

    def commit(self, entries: DataFrame, run: int) -> None:
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run}")


def land_new_messages(messages: DataFrame, ledger: OffsetLedger, raw_path: str, most: int | None = None) -> int | None:
    """Land what is new to the ledger's group as envelopes with status, below raw_path/run=<number>; the run's number, if any."""
    placed = messages.where("topic is not null and partition is not null and offset is not null")
    plan = to_scratch_table(ledger.plan(placed, most), "topic-plan")
    if plan.isEmpty():
        return None
    run = ledger.next_run()
    rows = placed.join(F.broadcast(plan), _PLACE).where("offset >= start and offset < until").drop("start", "until")
    rows = rows.dropDuplicates([*_PLACE, "offset"])
    landed = f"{raw_path}/run={run}"
    message_records(rows).withColumn("payload", F.col("payload").cast("string")).write.mode("overwrite").parquet(landed)
    # The source text of a landed row ends with its partition and offset.
    source = F.split("source", ":")
    stored = ledger.spark.read.parquet(landed).select(F.get(source, F.size(source) - 2).cast("int").alias("partition"), "source")
    topic = F.regexp_extract("source", r"^kafka:(.*):\d+:\d+$", 1)
    counted = stored.groupBy(topic.alias("topic"), "partition").agg(F.count(F.lit(1)).alias("rows"))
    entries = plan.join(F.broadcast(counted), _PLACE, "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
    ledger.commit(entries.select(*_PLACE, "start", "until", "rows", (F.col("until") - F.col("start") - F.col("rows")).alias("missing")), run)
    return run
