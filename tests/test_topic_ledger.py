import pytest
from pyspark.sql import functions as F

from sluiceway.sources.topic_ledger import OffsetLedger, land_new_messages


def _messages(spark, spans):
    """spans: (partition, first offset, last offset); payloads tell the offset."""
    parts = [spark.range(a, b + 1).select(F.lit("t").alias("topic"), F.lit(p).alias("partition"), F.col("id").alias("offset")) for p, a, b in spans]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    value = F.concat(F.lit('{"k":'), F.col("offset").cast("string"), F.lit("}"))
    return rows.withColumn("value", value.cast("binary")).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def _landed(spark, path):
    return sorted(r.source for r in spark.read.parquet(path).collect())


def test_overlapping_runs_land_every_message_once(spark, tmp_path, monkeypatch):
    ledger, raw = OffsetLedger(spark, str(tmp_path / "ledger"), "g"), str(tmp_path / "raw")
    assert land_new_messages(_messages(spark, [(0, 0, 9), (1, 5, 9)]), ledger, raw) == 0
    # A run that breaks before its entry is written is done again under the same number.
    with monkeypatch.context() as broken:
        broken.setattr(OffsetLedger, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("broken")))
        with pytest.raises(RuntimeError):
            land_new_messages(_messages(spark, [(0, 5, 12)]), ledger, raw)
    second = _messages(spark, [(0, 5, 14), (0, 10, 11), (1, 8, 9), (2, 0, 3)])
    assert land_new_messages(second, ledger, raw, most=4) == 1
    assert land_new_messages(second.where("offset <> 14 or partition <> 0").unionByName(_messages(spark, [(0, 16, 17)])), ledger, raw) == 2
    assert land_new_messages(second, ledger, raw) is None
    want = [f"kafka:t:0:{o}" for o in (*range(14), 16, 17)] + [f"kafka:t:1:{o}" for o in range(5, 10)] + [f"kafka:t:2:{o}" for o in range(4)]
    assert _landed(spark, raw) == sorted(want)
    got = {(r.run, r.partition): (r.start, r.until, r.rows, r.missing) for r in ledger.entries().collect()}
    assert got[1, 0] == (10, 14, 4, 0) and got[2, 0] == (14, 18, 2, 2) and got[0, 1] == (5, 10, 5, 0)
    # Another group reads from the start; nothing lands from a table without messages.
    other = OffsetLedger(spark, str(tmp_path / "ledger"), "h")
    assert land_new_messages(second.limit(0), other, str(tmp_path / "raw2")) is None
    assert land_new_messages(second, other, str(tmp_path / "raw2")) == 0
