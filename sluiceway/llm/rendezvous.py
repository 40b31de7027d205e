"""Sharding by weighted rendezvous hashing, with DataFrame functions alone.

A record's key is hashed with every shard's number to a uniform u; the shard with the greatest
weight / -ln(u) takes it (ties, to the last bit, go to the higher number). Shares follow the weights, and a
new shard only takes records, to itself. Assigning is a projection: nothing is shuffled, and any reader can
recompute it. A missing key is hashed as the empty text; repeated rows lie in one shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LAW = "key"
# Rows of one numbering group, so that no task numbers a whole shard.
SLOT_GROUP = 100_000


def shard_of(key: Column, weights: list[float]) -> Column:
    """Number of the shard that takes the key."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def draw(shard: int) -> Column:
        # 52 bits of the hash as a number inside (0, 1).
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), text), 12)
        return F.lit(float(weights[shard])) / -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52)))

    best = F.greatest(*[F.struct(draw(i).alias("draw"), F.lit(i).alias("shard")) for i in range(len(weights))]) if len(weights) > 1 else None
    return best["shard"] if best is not None else F.lit(0)


def with_shards(rows: DataFrame, key: str, weights: list[float], column: str = "shard") -> DataFrame:
    """Add the shard of each row; `weights` has one positive number per shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    return rows.withColumn(column, shard_of(F.col(key), weights))


def with_slots(rows: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add a gapless number from 0 within each shard, in the order of all columns inside groups of a shard's rows.

    Equal rows are counted first and spread again at the end, so a group of copies is one row on the way.
    The offsets of the groups are one small row each.
    """
    columns = [c for c in rows.columns if c != shard]
    counted = rows.groupBy(shard, *columns).agg(F.count(F.lit(1)).alias("_copies"))
    n = max(1, math.ceil((rows.count() or 1) / SLOT_GROUP))
    grouped = counted.withColumn("_group", F.pmod(F.xxhash64(*columns), F.lit(n)))
    running = Window.partitionBy(shard, "_group").orderBy(*columns)
    placed = grouped.withColumn("_at", F.sum("_copies").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies"))
    sizes = grouped.groupBy(shard, "_group").agg(F.sum("_copies").alias("_size"))
    before = Window.partitionBy(shard).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(shard).alias("_s"), F.col("_group").alias("_g"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    first = F.col("_offset") + F.col("_at")
    return (
        placed.join(offsets, (F.col(shard) == F.col("_s")) & (F.col("_group") == F.col("_g")))
        .withColumn(slot, F.explode(F.sequence(first, first + F.col("_copies") - 1)))
        .select(*rows.columns, slot)
    )


def placements(docs: DataFrame, weights: list[float]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard of weight 1) of every document."""
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(doc_id.alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    placed = with_slots(with_shards(slim, "doc_id", weights))
    grown = shard_of(F.col("doc_id"), [*weights, 1.0])
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", grown.alias("grown_shard"))
