import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.clean import flatten_payload, validate, validate_counted, validation_report
from sluiceway.operators.features import FeatureTransformer
from sluiceway.operators.sinks import land_jsonl, materialise
from sluiceway.plans.feature_build import build_features
from sluiceway.plans.ingestion import ingest_api, ingest_files, ingest_messages
from sluiceway.schemas import KAFKA_MESSAGE, RAW_RECORD
from sluiceway.sources.envelope import to_raw_envelope
from sluiceway.sources.files import load_raw, load_raw_records, scan_batch
from sluiceway.sources.kafka import message_records
from sluiceway.sources.paged_api import PageReader, api_records, scan_pages, unpack_pages
from sluiceway.streaming.counters import count_statuses, keep_last_rows, latest_counts, rolling_snapshot
from sluiceway.streaming.ingest import land_feedback
from sluiceway.operators.service_metrics import service_snapshot


def test_validate_drops_copies_and_empty_rows(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (None, None, float("nan")), (None, None, None), (2, None, None)]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    assert sorted(r.k for r in validate(df).collect()) == [1, 2]
    kept, before, after = validate_counted(df)
    kept.collect()
    assert (before.get["rows"], after.get["rows"]) == (5, 2)
    assert tuple(validation_report(df).first()) == (5, 2, 3)


def test_flatten_payload(spark):
    rows = [("1", '{"a":{"b":1},"c":[1,2]}'), ("2", '{"d":2}'), ("3", "[7]"), ("4", '{"a.b":5, "e f":1.5, "g":null}'), ("5", None)]
    out = flatten_payload(spark.createDataFrame(rows, "id string, payload string"))
    got = {r["id"]: (r["a.b"], r["c"], r["d"], r["e f"], r["g"]) for r in out.collect()}
    assert got == {"1": (1, [1, 2], None, None, None), "2": (None, None, 2, None, None), "3": (None,) * 5, "4": (5, None, None, 1.5, None), "5": (None,) * 5}
    whole = flatten_payload(spark.createDataFrame([('{"x":3.0}',), ('{"x":4}',)], "payload string"))
    assert {r.x for r in whole.collect()} == {3.0, 4.0}
    mixed = flatten_payload(spark.createDataFrame([('{"x":1}',), ('{"x":"t"}',)], "payload string"))
    assert {r.x for r in mixed.collect()} == {"1", "t"}
    with pytest.raises(ValueError, match="already columns"):
        flatten_payload(spark.createDataFrame([("1", '{"id":2}')], "id string, payload string"))
    assert flatten_payload(spark.range(1)).columns == ["id"]


def test_payload_keys_that_differ_in_case_raise(spark):
    for bodies in (['{"a":1}', '{"A":2}'], ['{"x":{"k":1,"K":2}}'], ['{"x":[{"k":1},{"K":2}]}']):
        with pytest.raises(ValueError, match="differ only in case"):
            flatten_payload(spark.createDataFrame([(b,) for b in bodies], "payload string"))
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_scan_batch_reads_both_formats_recursively(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (None, "y")], "id int, a string").write.parquet(str(tmp_path / "in" / "deep" / "p"))
    (tmp_path / "in" / "t.csv").write_text("id,b\n7,2.5\n")
    (tmp_path / "in" / "skip.txt").write_text("no\n")
    rows = scan_batch(spark, str(tmp_path / "in")).collect()
    assert [f.name for f in scan_batch(spark, str(tmp_path / "in")).schema.fields] == RAW_RECORD.names
    by_payload = {r.payload: r for r in rows}
    assert set(by_payload) == {'{"id":1,"a":"x"}', '{"a":"y"}', '{"id":7,"b":2.5}'}
    assert by_payload['{"id":1,"a":"x"}'].id == "1" and len(by_payload['{"a":"y"}'].id) == 36
    assert by_payload['{"id":7,"b":2.5}'].source.endswith("t.csv") and {r.schema_version for r in rows} == {"1.0"}
    with pytest.raises(FileNotFoundError):
        scan_batch(spark, str(tmp_path / "nothing"))


def test_rows_without_an_id_column_get_one(spark):
    ids = [r.id for r in to_raw_envelope(spark.range(3).toDF("n"), source=F.lit("s")).collect()]
    assert len(set(ids)) == 3 and all(len(i) == 36 for i in ids)


def test_raw_zone_round_trip_and_union_by_name(spark, tmp_path):
    raw = str(tmp_path / "raw")
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, a string")
    assert land_jsonl(to_raw_envelope(df, source=F.lit("s")), f"{raw}/one") == 2
    assert land_jsonl(to_raw_envelope(df, source=F.lit("s")), f"{raw}/one") == 2
    (tmp_path / "raw" / "nested.jsonl").write_text(
        json.dumps({"id": "9", "source": "f", "timestamp": "2024-01-01T00:00:00Z", "payload": {"a": {"b": 1}}, "schema_version": "1.0"}) + "\n"
    )
    (tmp_path / "raw" / "feedback").mkdir()
    (tmp_path / "raw" / "feedback" / "f.jsonl").write_text('{"id":"no"}\n')
    rows = load_raw_records(spark, raw, exclude=("feedback",)).collect()
    assert sorted(r.id for r in rows) == ["1", "1", "2", "2", "9"]
    assert load_raw_records(spark, raw).count() == 6
    assert [json.loads(r.payload) for r in rows if r.id == "9"] == [{"a": {"b": 1}}]
    spark.createDataFrame([(5, 1.5)], "id int, z double").write.parquet(f"{raw}/two")
    merged = load_raw(spark, raw, exclude=("feedback",))
    assert {"id", "payload", "z"} <= set(merged.columns) and merged.count() == 6
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "nothing"))


def test_materialise_flattens_and_overwrites(spark, tmp_path):
    df = spark.createDataFrame([("1", '{"v":3}')], "id string, payload string")
    for _ in range(2):
        out = materialise(df, str(tmp_path), "val")
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("1", 3)]


def test_feature_job(spark, tmp_path):
    rows = [(i, f"some text {i % 40}", float(i % 40)) for i in range(40)] + [(3, "some text 3", 3.0)]
    df = spark.createDataFrame(rows, "doc int, text string, x double").repartition(3)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "features")
    land_jsonl(to_raw_envelope(df, "doc", F.lit("s")), raw)
    paths = build_features(spark, raw, out, FeatureTransformer().add_scaler("x", "minmax"), id_col="doc")
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts == {"train": 32, "val": 4, "test": 4}
    train = spark.read.parquet(paths["train"])
    assert (train.agg(F.min("x"), F.max("x")).first()) == (0.0, 1.0)
    assert {"text_len", "word_count"} <= set(train.columns)


# ---- paged interface ----------------------------------------------------------------------------


def pages_of(shapes):
    def fetch(url, params, timeout):
        return json.dumps(shapes[params["page"] - 1])

    return fetch


PAGES = [
    {"items": [{"id": 1, "v": {"w": 1}}, {"v": 2}], "has_more": True},
    {"results": [{"id": 3}], "next_page": 3},
    {"items": [], "has_more": True},
    {"id": 4, "has_more": False},
    {"items": [{"id": "beyond"}]},
]


def test_pages_follow_their_flags(spark):
    pages = scan_pages(spark, "http://x", pages_of(PAGES), requestsPerSecond=1000)
    items = unpack_pages(pages).collect()
    assert sorted((r.page, r.item) for r in items) == [
        (1, '{"id":1,"v":{"w":1}}'), (1, '{"v":2}'), (2, '{"id":3}'), (4, '{"id": 4, "has_more": false}')
    ]
    records = api_records(pages, "http://x").collect()
    assert {r.id for r in records if len(r.id) < 36} == {"1", "3", "4"} and {r.source for r in records} == {"http://x"}


def test_pages_are_read_by_ranges(spark, tmp_path):
    shapes = [{"items": [{"id": p}]} for p in range(1, 24)]
    df = scan_pages(spark, "u", pages_of(shapes), pages=23, partitions=4, requestsPerSecond=10000)
    assert df.rdd.getNumPartitions() == 4 and sorted(r.page for r in df.collect()) == list(range(1, 24))
    assert ingest_api(spark, "u", str(tmp_path / "raw"), fetch=pages_of(shapes), pages=23, requestsPerSecond=10000) == 23


def test_page_requests_are_retried_and_paced():
    calls = []

    def flaky(url, params, timeout):
        calls.append((params, timeout))
        if len(calls) < 3:
            raise OSError("down")
        return "{}"

    options = {"url": "u", "waitMin": "0", "waitMax": "0"}
    reader = PageReader(flaky, options)
    assert list(reader.read(reader.partitions()[0])) == [(1, "{}")]
    assert calls[0] == ({"page": 1, "per_page": 100}, 30.0) and len(calls) == 3
    assert reader.interval == pytest.approx(0.1)
    assert PageReader(flaky, options | {"pages": "8", "partitions": "4"}).interval == pytest.approx(0.4)

    def dead(url, params, timeout):
        raise OSError("gone")

    with pytest.raises(OSError):
        list(PageReader(dead, options).read(reader.partitions()[0]))


# ---- streams ------------------------------------------------------------------------------------


def message_rows():
    values = ['{"k": 1}', "{bad", '{"k": {"n": 2}}', "[3]", '"text"']
    return [(None, v.encode(), "t", i % 2, i, dt.datetime(2024, 1, 1, 0, 0, i)) for i, v in enumerate(values)]


def test_messages_become_records_or_quarantine(spark):
    df = spark.createDataFrame(message_rows(), KAFKA_MESSAGE)
    rows = message_records(df).collect()
    assert [(r.source, r.status) for r in rows] == [
        ("kafka:t:0:0", "ok"), ("kafka:t:1:1", "quarantine"), ("kafka:t:0:2", "ok"), ("kafka:t:1:3", "quarantine"), ("kafka:t:0:4", "quarantine")
    ]
    assert rows[2].payload == '{"k": {"n": 2}}' and rows[0].timestamp == dt.datetime(2024, 1, 1)
    with pytest.raises(Exception, match="MALFORMED|malformed|{bad"):
        message_records(df, failfast=True).collect()


def streamed(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_landing_is_exactly_once_over_restarts(spark, tmp_path):
    source, raw, mark = (str(tmp_path / n) for n in ("topic", "raw", "mark"))
    df = spark.createDataFrame(message_rows(), KAFKA_MESSAGE)
    for part in ("offset < 3", "offset >= 3"):
        ingest_messages(streamed(spark, df.where(part), source), raw, mark)
    ingest_messages(spark.readStream.schema(df.schema).parquet(source), raw, mark)
    good = spark.read.json(f"{raw}/status=ok")
    assert sorted(r.source for r in good.collect()) == ["kafka:t:0:0", "kafka:t:0:2"]
    assert spark.read.json(f"{raw}/status=quarantine").count() == 3


def test_running_counts(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("log", "out", "mark"))
    for rows in ([("ok",), ("error",)], [("ok",), ("ok",)]):
        stream = streamed(spark, spark.createDataFrame(rows, "status string"), source)
        count_statuses(stream, out, mark).awaitTermination()
    assert {r.status: r.requests for r in latest_counts(spark, out).collect()} == {"ok": 3, "error": 1}
    # Further batches replace the older of two versions.
    for i in range(3):
        stream = streamed(spark, spark.createDataFrame([("ok",)], "status string"), source)
        count_statuses(stream, out, mark).awaitTermination()
        assert sorted(os.listdir(out)) == ["slot=0", "slot=1"]
        assert spark.read.parquet(out).count() == 4
        assert {r.status: r.requests for r in latest_counts(spark, out).collect()} == {"ok": 4 + i, "error": 1}


def test_rolling_state_equals_the_batch_window(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("log", "out", "mark"))
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=(i * 37) % 101), "a" if i % 4 else "b", float((i * 13) % 97), False) for i in range(101)]
    df = spark.createDataFrame(rows, "seq bigint, ts timestamp, service string, latency_ms double, error boolean")
    for part in ("seq < 40", "seq between 40 and 69", "seq >= 70"):
        keep_last_rows(streamed(spark, df.where(part), source), out, mark, window=10).awaitTermination()
    assert sorted(os.listdir(out)) == ["slot=0", "slot=1"] and spark.read.parquet(out).count() == 40
    figures = ["mean_ms", "p50_ms", "p95_ms", "p99_ms"]
    got = {r.service: [r[f] for f in figures] for r in rolling_snapshot(spark, out, 10).collect()}
    batch = {r.service: [r[f] for f in figures] for r in service_snapshot(df, group="service", window=10).collect()}
    assert got == {k: pytest.approx(v) for k, v in batch.items()}


def test_a_repeated_batch_starts_from_the_version_before_it(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("log", "out", "mark"))
    schema = "seq bigint, ts timestamp, service string, latency_ms double"
    start = dt.datetime(2024, 1, 1)
    for seqs in ((0, 1), (2, 3), (4, 5)):
        rows = [(i, start + dt.timedelta(seconds=i), "a", float(i)) for i in seqs]
        keep_last_rows(streamed(spark, spark.createDataFrame(rows, schema), source), out, mark, window=3).awaitTermination()
    # As if the last batch had written its rows and failed before it was committed.
    for name in ("2", ".2.crc"):
        os.remove(f"{mark}/commits/{name}")
    keep_last_rows(spark.readStream.schema(schema).parquet(source), out, mark, window=3).awaitTermination()
    newest = spark.read.parquet(out).where("batch = 2")
    assert sorted(r.latency for r in newest.collect()) == [3.0, 4.0, 5.0]
    assert rolling_snapshot(spark, out, 3).first().mean_ms == 4.0


def test_feedback_stream(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("bodies", "out", "mark"))
    stream = streamed(spark, spark.createDataFrame([('{"true_label":1}',), ("{}",)], "body string"), source)
    land_feedback(stream, out, mark).awaitTermination()
    assert sorted((r.prediction_id, r.true_label or "") for r in spark.read.json(out).collect()) == [("unknown", ""), ("unknown", "1")]


def test_file_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text("id,b\n7,2.5\n8,1.0\n")
    assert ingest_files(spark, str(tmp_path / "in"), str(tmp_path / "raw")) == 2
    assert load_raw_records(spark, str(tmp_path / "raw")).count() == 2


def test_only_folders_below_the_root_are_excluded(spark, tmp_path):
    from sluiceway.sources.files import load_raw

    root = tmp_path / "feedback" / "raw zone"
    spark.createDataFrame([(1,), (2,)], "id long").write.parquet(str(root / "a"))
    spark.createDataFrame([(3,)], "id long").write.parquet(str(root / "feedback"))
    assert sorted(r.id for r in load_raw(spark, str(root), exclude=("feedback",)).collect()) == [1, 2]
    assert sorted(r.id for r in load_raw(spark, f"file://{root}/", exclude=("feedback",)).collect()) == [1, 2]
    assert sorted(r.id for r in load_raw(spark, str(root)).collect()) == [1, 2, 3]
