import datetime as dt
import hashlib
import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.functions.vector import arg_max, l2_normalise, squared_l2
from sluiceway.operators.requests import (
    check_predict_requests,
    check_retrieval_requests,
    explode_inputs,
    feedback_records,
    quarantine_records,
)
from sluiceway.operators.retrieval import (
    answer_with,
    append_vectors,
    build_prompts,
    embed_with,
    hash_embedding,
    nearest,
    searchable,
    with_passages,
)
from sluiceway.operators import retrieval, vector_index
from sluiceway.operators.vector_index import build_index, nearest_indexed
from sluiceway.plans.question_answering import prompts_for


def vectors(spark, rows, key="vec_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], f"{key} bigint, embedding array<float>")


def brute(queries, corpus, k):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1), 1e-12)[:, None]
    q, c = unit(np.asarray(queries, np.float32).astype(float)), unit(np.asarray(corpus, np.float32).astype(float))
    d = ((q[:, None] - c[None]) ** 2).sum(-1)
    return {(i, r + 1): int(v) for i in range(len(q)) for r, v in enumerate(np.lexsort((np.arange(len(c)), d[i]))[:k])}, d


def test_unit_axes(spark):
    corpus = vectors(spark, np.eye(3))
    hits = {(r.query_id, r["rank"]): r for r in nearest(vectors(spark, [[5, 0, 0]], "query_id"), corpus, 10).collect()}
    assert len(hits) == 3
    assert (hits[0, 1].vec_id, hits[0, 1].distance, hits[0, 1].score) == (0, 0.0, 1.0)
    assert hits[0, 2].vec_id == 1 and hits[0, 2].distance == pytest.approx(2.0) and hits[0, 2].score == pytest.approx(1 / 3)


@pytest.mark.parametrize("blocks", [False, True])
def test_search_equals_brute_force_with_many_copies(spark, blocks):
    draw = np.random.default_rng(0)
    corpus = draw.normal(size=(300, 8))
    corpus[100:220] = corpus[5]
    queries = np.concatenate([draw.normal(size=(20, 8)), corpus[5:6]])
    options = {"broadcast_bytes": 0, "block_rows": 50} if blocks else {}
    hits = nearest(vectors(spark, queries, "query_id"), vectors(spark, corpus).repartition(5), 7, **options).collect()
    expected, d = brute(queries, corpus, 7)
    assert {(r.query_id, r["rank"]): r.vec_id for r in hits} == expected
    assert all(r.distance == pytest.approx(d[r.query_id, r.vec_id], abs=1e-9) for r in hits)


@pytest.mark.parametrize("blocks", [False, True])
def test_text_ids_and_vectors_without_a_passage(spark, blocks):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [1.0, 0.1]), ("d", [0.0, 1.0])], "vec_id string, embedding array<float>")
    asked = spark.createDataFrame([("q1", [2.0, 0.0]), ("q2", [0.0, 3.0])], "query_id string, embedding array<float>")
    options = {"broadcast_bytes": 0, "block_rows": 1} if blocks else {}
    hits = nearest(asked, corpus.repartition(3), 2, **options).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in hits) == [("q1", 1, "a"), ("q1", 2, "b"), ("q2", 1, "d"), ("q2", 2, "c")]
    passages = spark.createDataFrame([("b", "t"), ("d", "u")], "vec_id string, text string")
    found = with_passages(nearest(asked, searchable(corpus, passages), 2, **options), passages)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect()) == [("q1", 1, "b"), ("q1", 2, "d"), ("q2", 1, "d"), ("q2", 2, "b")]


def test_search_edge_inputs(spark):
    corpus = vectors(spark, np.eye(2))
    assert nearest(vectors(spark, [[1, 0]], "query_id").where("query_id < 0"), corpus).count() == 0
    assert nearest(vectors(spark, [[1, 0]], "query_id"), corpus.where("vec_id < 0")).count() == 0
    with pytest.raises(Exception, match="not of length 3"):
        nearest(vectors(spark, [[1, 0, 0]], "query_id"), corpus).collect()


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    row = df.select(l2_normalise(F.col("a")).alias("u"), l2_normalise(F.col("b")).alias("z"), squared_l2(F.col("a"), F.col("b")).alias("d"), arg_max(F.col("a")).alias("m")).first()
    assert row.u == pytest.approx([0.6, 0.8]) and row.z == [0.0, 0.0] and (row.d, row.m) == (25.0, 1)


def test_corpus_grows_in_order(spark, tmp_path):
    path = str(tmp_path / "vectors")
    df = spark.createDataFrame([(2, "b", [0.0, 2.0]), (1, "a", [3.0, 4.0])], "n int, text string, embedding array<float>")
    append_vectors(df, path, ["n"])
    append_vectors(df.where("n = 1").withColumn("metadata", F.create_map(F.lit("k"), F.lit("v"))), path, ["n"])
    append_vectors(df.where("n = 2"), path, ["n"])
    rows = spark.read.parquet(path).orderBy("vec_id").collect()
    assert [(r.vec_id, r.text, r.metadata) for r in rows] == [(0, "a", {}), (1, "b", {}), (2, "a", {"k": "v"}), (3, "b", {})]
    assert rows[0].embedding == pytest.approx([0.6, 0.8])


def test_embeddings(spark):
    df = spark.createDataFrame([("a b a",), ("",)], "text string")
    rows = hash_embedding(df, dimensions=32).collect()
    assert len(rows[0].embedding) == 32 and sum(x * x for x in rows[0].embedding) == pytest.approx(1.0)
    assert set(rows[1].embedding) == {0.0}

    def encoder():
        return lambda batch: [np.array([len(t), 0.0]) for t in batch]

    assert embed_with(df, encoder).first().embedding == [1.0, 0.0]


def test_prompts(spark):
    hits = spark.createDataFrame([(1, 2, 11, 0.5), (1, 1, 10, 0.9), (1, 3, 99, 0.1)], "query_id bigint, rank int, vec_id bigint, score double")
    passages = spark.createDataFrame([(10, "ten", {"k": "v"}), (11, "eleven", None)], "vec_id bigint, text string, metadata map<string,string>")
    questions = spark.createDataFrame([(1, "why?"), (2, "alone?")], "query_id bigint, query string")
    rows = {r.query_id: r for r in build_prompts(questions, with_passages(hits, passages)).collect()}
    assert rows[1].prompt == "Context:\n[1] ten\n\n[2] eleven\n\nQuestion: why?\nAnswer:"
    assert [s.metadata for s in rows[1].sources] == [{"k": "v"}, {}]
    assert rows[2].prompt == "Context:\n\n\nQuestion: alone?\nAnswer:"

    def generator():
        return lambda batch: [p[-20:].upper() for p in batch]

    assert answer_with(build_prompts(questions, with_passages(hits, passages)), generator).count() == 2


def test_questions_to_prompts(spark):
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(["red apple", "blue sky", "green tree"])], "vec_id bigint, text string")
    corpus = hash_embedding(corpus)
    requests = spark.createDataFrame([(1, "blue sky", 1), (2, "x" * 2001, 1), (3, "red", 99)], "query_id bigint, query string, top_k int")
    rows = prompts_for(requests, corpus).collect()
    assert [(r.query_id, r.context) for r in rows] == [(1, "[1] blue sky")]


# ---- requests -----------------------------------------------------------------------------------


def test_predict_requests(spark):
    rows = [(["a", "b"], "3"), (["a"], None), ([], "x"), (["t"] * 64, None), (["t"] * 65, None), (None, None)]
    df = spark.createDataFrame(rows, "inputs array<string>, model_version string")
    got = [(r.valid, r.model_version) for r in check_predict_requests(df).collect()]
    assert got == [(True, "3"), (True, "champion"), (False, "x"), (True, "champion"), (False, "champion"), (False, "champion")]
    assert [tuple(r) for r in explode_inputs(df.limit(1)).collect()] == [("3", 0, "a"), ("3", 1, "b")]


def test_retrieval_requests(spark):
    rows = [("q", None, None), ("", 5, 0.2), ("q" * 2000, 20, 2.0), ("q" * 2001, 1, 0.0), ("q", 0, 0.0), ("q", 21, 0.0), ("q", 1, 2.1), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "query string, top_k int, temperature double")
    got = check_retrieval_requests(df).collect()
    assert [r.problem for r in got] == [None, "query", None, "query", "top_k", "top_k", "temperature", "query"]
    assert (got[0].top_k, got[0].temperature, got[0].valid) == (5, 0.2, True)


def test_feedback_defaults(spark):
    bodies = ['{"prediction_id":"abc-123","true_label":1,"predicted_label":0,"source":"test"}', "{}", '{"source":null}', "{bad", None, "[1]"]
    rows = feedback_records(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert [(r.prediction_id, r.true_label, r.predicted_label, r.source) for r in rows] == [
        ("abc-123", "1", "0", "test"), ("unknown", None, None, "api"), ("unknown", None, None, "api")
    ]


def test_record_quarantine(spark):
    rows = [("1", "s", dt.datetime(2024, 1, 1), json.dumps({"x": 1})), (None, "s", dt.datetime(2024, 1, 1), "{}"), ("2", "s", None, "{}"), ("3", "s", dt.datetime(2024, 1, 1), "[1]")]
    df = spark.createDataFrame(rows, "id string, source string, timestamp timestamp, payload string")
    good, bad = quarantine_records(df)
    assert [r.id for r in good.collect()] == ["1"] and sorted(r.problem for r in bad.collect()) == ["id", "payload", "timestamp"]


@pytest.mark.parametrize("shape", ["clusters", "noise", "copies"])
def test_indexed_search_equals_exhaustive_search(spark, tmp_path, shape):
    draw = np.random.default_rng(5)
    corpus = draw.normal(size=(700, 6))
    if shape == "clusters":
        corpus = corpus * 0.03 + draw.normal(size=(9, 6))[draw.integers(9, size=700)]
    if shape == "copies":
        corpus[:300] = corpus[7]
    queries = np.concatenate([corpus[::50], draw.normal(size=(10, 6))])
    asked, held = vectors(spark, queries, "query_id"), vectors(spark, corpus).repartition(4)
    build_index(held, str(tmp_path), sample_rows=200)
    for k, part_bytes in [(1, 1 << 20), (7, 500), (900, 1 << 20)]:
        got = {tuple(r)[:3] for r in nearest_indexed(spark, asked, str(tmp_path), k, part_bytes).collect()}
        assert got == {tuple(r)[:3] for r in nearest(asked, held, k).collect()}


def test_indexed_search_skips_cells_and_has_no_exchange_below(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(6)
    corpus = draw.normal(size=(2000, 4)) * 0.01 + draw.normal(size=(20, 4))[draw.integers(20, size=2000)]
    build_index(vectors(spark, corpus), str(tmp_path), cells=20)
    looked, real = [], vector_index._lookers
    monkeypatch.setattr(vector_index, "_lookers", lambda pairs: looked.append(pairs.mean()) or real(pairs))
    hits = nearest_indexed(spark, vectors(spark, corpus[:40], "query_id"), str(tmp_path), 3)
    assert hits.count() == 120 and max(looked) < 0.3
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan[plan.index("MapInArrow") :]


def test_indexed_search_of_text_ids_and_of_nothing(spark, tmp_path):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("n", None)], "vec_id string, embedding array<float>")
    asked = spark.createDataFrame([("q", [2.0, 0.1]), ("null", None)], "query_id string, embedding array<float>")
    build_index(corpus, str(tmp_path / "i"))
    got = nearest_indexed(spark, asked, str(tmp_path / "i"), 2).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [("q", 1, "a"), ("q", 2, "b")]
    assert nearest_indexed(spark, asked.limit(0), str(tmp_path / "i")).collect() == []
    build_index(corpus.limit(0), str(tmp_path / "none"))
    assert nearest_indexed(spark, asked, str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError, match="length"):
        build_index(corpus.union(spark.createDataFrame([("z", [1.0])], corpus.schema)), str(tmp_path / "bad"))


def test_indexed_search_over_many_files_and_batches(spark, tmp_path):
    """Copies and near copies go over several files and Arrow batches; results stay those of the exhaustive search."""
    draw = np.random.default_rng(8)
    corpus = draw.normal(size=(20_000, 8))
    corpus[:9000] = corpus[3]
    corpus[9000:9500] = corpus[9000] + draw.normal(size=(500, 8)) * 1e-4
    queries = np.concatenate([corpus[[3, 9000, 9001, 15_000]], draw.normal(size=(60, 8))])
    asked, held = vectors(spark, queries, "query_id"), vectors(spark, corpus)
    build_index(held, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/vectors").select("_metadata.file_path").distinct().count() >= 3
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = sorted(tuple(r)[:3] for r in nearest_indexed(spark, asked, str(tmp_path), 4, 1500).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(tuple(r)[:3] for r in nearest(asked, held, 4).collect()) and len(got) == 64 * 4


def test_queries_of_a_cell_travel_as_bits():
    pairs = np.random.default_rng(9).random((1001, 30)) < 0.9
    bits = vector_index._lookers(pairs)
    assert bits.nbytes == 30 * 126  # not eight bytes for each pair
    assert all((np.unpackbits(bits[c], count=1001) == pairs[:, c]).all() for c in range(30))


def test_copies_beyond_k_are_passed_over():
    cells, gaps = np.array([0, 0, 0, 0, 1, 1]), np.array([0.5, 0.5, 0.5, 0.6, 0.6, 0.6])
    embedding = np.array([[1.0, 0], [1, 0], [1, 0], [1, 0], [0, 1], [1, 0]])
    assert vector_index._needed(cells, gaps, np.arange(6), embedding, 2).tolist() == [True, True, False, True, True, True]
    assert vector_index._needed(cells, gaps, np.arange(6)[::-1], embedding, 1).all()  # of another file: not by rising id


def test_default_embedding_holds_the_words_of_a_slice(spark, monkeypatch):
    texts = ["a b", None, "", "long " * 30 + "x\u00a0y", "c", "d e f"]
    expected = [(x or "").split() for x in texts]
    with monkeypatch.context() as small:
        small.setattr(retrieval, "SLICE_BYTES", 40)
        small.setattr(retrieval, "SLICE_WORDS", 7)
        small.setattr(retrieval, "SLICE_ROWS", 2)
        got, most = [[] for _ in texts], 0
        for at, some in retrieval._text_slices(pa.array(texts)):
            assert len(some) <= 2
            for found in retrieval._word_lists(some):
                most = max(most, sum(map(len, found)))
                for i, own in enumerate(found):
                    got[at + i] += own
    assert got == expected and most <= 7
    long = " ".join(f"w{i % 500}" for i in range(300_000))
    rows = hash_embedding(spark.createDataFrame([(long,), ("w1 W2",), (None,)], "text string").coalesce(1), dimensions=32).collect()
    counts = np.zeros(32)
    for w in long.split():
        counts[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 32] += 1
    assert rows[0].embedding == (counts / np.sqrt((counts * counts).sum())).astype(np.float32).tolist()
    assert sum(x * x for x in rows[1].embedding) == pytest.approx(1) and not any(rows[2].embedding)


def test_default_embedding_of_odd_texts(spark):
    df = spark.createDataFrame([("A a b\u00a0c\x1cd",), ("",), (None,), (" \n",)], "text string")
    rows = [r.embedding for r in hash_embedding(df, dimensions=16).collect()]
    assert sum(x * x for x in rows[0]) == pytest.approx(1) and all(not any(r) and len(r) == 16 for r in rows[1:])
