"""Retrieval, prompts, request validation, feedback."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import rounded, table
from sluiceway.functions.vector import arg_max, l2_norm, l2_normalise, squared_l2
from sluiceway.operators.requests import (
    check_predict_requests,
    check_retrieval_requests,
    explode_inputs,
    feedback_records,
)
from sluiceway.operators.retrieval import append_vectors, hash_embedding, nearest, searchable, with_passages
from sluiceway.operators.sinks import append_feedback
from sluiceway.operators.vector_index import build_index, nearest_indexed
from sluiceway.operators.vector_store import VectorStore
from sluiceway.plans.question_answering import prompts_for
from sluiceway.schemas import FEEDBACK_RECORD
from sluiceway.session import scratch_path
from sluiceway.sources.files import feedback_count


def topk_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector asks for its five nearest of those with a passage, with the text length of the passage found."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    passages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    hits = nearest(vectors.withColumnRenamed("vec_id", "query_id"), searchable(vectors, passages))
    return with_passages(hits, passages).select(
        "query_id", "rank", "vec_id", rounded("distance"), rounded("score"), F.length("text").alias("passage_chars")
    )


def indexed_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As topk_retrieval, over a stored index of the vectors with a passage."""
    path = scratch_path(spark, "index")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    passages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    build_index(searchable(vectors, passages), path)
    hits = nearest_indexed(spark, vectors.withColumnRenamed("vec_id", "query_id"), path)
    return with_passages(hits, passages).select(
        "query_id", "rank", "vec_id", rounded("distance"), rounded("score"), F.length("text").alias("passage_chars")
    )


def rag_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document short enough to be a question, answered from the passages nearest to its vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    requests = documents.join(vectors, "vec_id").select(
        F.col("vec_id").alias("query_id"), F.col("text").alias("query"), "embedding", F.lit(3).alias("top_k")
    )
    return prompts_for(requests, vectors, passages=documents).select("query_id", "prompt")


def text_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts ask the documents, both embedded by the default embedding."""
    corpus = hash_embedding(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("vec_id"), "embedding")
    asked = hash_embedding(table(spark, sf_dir, "benchmark")).select(F.col("item_id").alias("query_id"), "embedding")
    return nearest(asked, corpus, 10).select("query_id", "rank", "vec_id", rounded("distance"), rounded("score"))


def vector_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the vectors to a new corpus in two steps; ids go on from the first step."""
    path = scratch_path(spark, "vectors")
    source = table(spark, sf_dir, "embeddings").join(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text"), "vec_id"
    )
    first, second = source.where("label < 5"), source.where("label >= 5")
    append_vectors(first, path, ["label", "vec_id"])
    append_vectors(second, path, ["label", "vec_id"])
    stored = spark.read.parquet(path)
    return stored.select(
        "vec_id", F.length("text").alias("chars"), F.round(l2_norm(F.col("embedding")), 4).alias("norm"), F.size("metadata").alias("entries")
    )


def vector_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers at once, each language's documents a batch, embedded on the way in; one batch is brought twice.

    Whose ids come first is open, so ids are shown from the first of their batch on; the totals show that none is double or missing.
    """
    store = VectorStore(spark, scratch_path(spark, "store"))
    documents = table(spark, sf_dir, "documents").withColumn("batch", F.coalesce("lang", F.lit("none")))
    documents = documents.withColumn("metadata", F.create_map(F.lit("batch"), F.col("batch")))
    batches = [r.batch for r in documents.select("batch").distinct().orderBy("batch").collect()]
    with ThreadPoolExecutor(3) as writers:
        list(writers.map(lambda b: store.append_texts(documents.where(F.col("batch") == b), b, ["doc_id"]), batches))
    store.append_texts(documents.where(F.col("batch") == batches[0]), batches[0], ["doc_id"])
    stored = store.read()
    total = stored.agg(F.countDistinct("vec_id").alias("ids"), F.max("vec_id").alias("last_id"))
    claimed = store.entries().select(F.col("key").alias("batch"), "first", F.col("rows").alias("batch_rows"))
    return (
        stored.withColumn("batch", F.col("metadata")["batch"])
        .join(F.broadcast(claimed), "batch")  # one row per language
        .join(F.broadcast(total))  # a single row
        .select("batch", (F.col("vec_id") - F.col("first")).alias("place"), F.length("text").alias("chars"), "batch_rows", "ids", "last_id")
    )


def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each unit vector to its successor."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", l2_normalise(F.col("embedding")).alias("e"))
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("e").alias("e2"))
    return vectors.join(after, "vec_id").select("vec_id", F.round(squared_l2(F.col("e"), F.col("e2")), 6).alias("distance"))


def argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", arg_max(F.col("embedding")).cast("bigint").alias("label"))


def predict_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each turn as the inputs of one request; blank turns of the system have none."""
    lines = F.when(F.col("role") == "system", F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    requests = table(spark, sf_dir, "conversations").select("conv_id", "turn", lines.alias("inputs"))
    return check_predict_requests(requests).select("conv_id", "turn", F.size("inputs").alias("n_inputs"), "model_version", "valid")


def scoring_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("inputs"))
    return explode_inputs(requests)


def retrieval_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("query"),
        F.when(F.col("turn") != 3, F.col("turn") * 4).alias("top_k"),
        F.when(F.col("turn") != 5, F.pmod("conv_id", F.lit(5)) * 0.6).alias("temperature"),
    )
    checked = check_retrieval_requests(requests)
    return checked.select(
        "conv_id", "turn", "top_k", rounded("temperature", 3), "valid", F.coalesce("problem", F.lit("none")).alias("problem")
    )


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback bodies: errors lack the prediction id, sign-ups the source."""
    return table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("prediction_id"),
                F.get_json_object("props", "$.k").alias("true_label"),
                F.when(F.col("event_type") != "signup", F.col("event_type")).alias("source"),
            )
        ).alias("body")
    )


def feedback_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = feedback_records(_bodies(spark, sf_dir))
    return records.select("prediction_id", "true_label", F.coalesce("predicted_label", F.lit("null")).alias("predicted_label"), "source")


def feedback_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the feedback, read it back and count its lines."""
    path = scratch_path(spark, "feedback")
    append_feedback(feedback_records(_bodies(spark, sf_dir)), path)
    lines = feedback_count(spark, path).scalar()
    stored = spark.read.schema(FEEDBACK_RECORD).json(path)
    return stored.groupBy("source").agg(F.count(F.lit(1)).alias("records")).select("source", "records", lines.alias("feedback_rows"))


QUERIES = {
    "topk_retrieval": topk_retrieval,
    "indexed_retrieval": indexed_retrieval,
    "rag_prompt": rag_prompt,
    "text_retrieval": text_retrieval,
    "vector_store": vector_store,
    "vector_writers": vector_writers,
    "vector_neighbours": vector_neighbours,
    "argmax_label": argmax_label,
    "predict_request_validation": predict_requests,
    "scoring_inputs": scoring_inputs,
    "retrieval_request_validation": retrieval_requests,
    "feedback_defaults": feedback_defaults,
    "feedback_log": feedback_log,
}

_TOP = """
    unit AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x:
                    x / greatest(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12)) AS e FROM embeddings),
    near AS (SELECT q.vec_id AS query_id, c.vec_id, pow(list_distance(q.e, c.e), 2) AS d FROM unit q, unit c),
    -- only vectors with a passage are searched
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank
               FROM near WHERE vec_id IN (SELECT doc_id FROM documents))"""

ORACLES = {
    "topk_retrieval": f"""
        WITH {_TOP}
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 6) AS distance, round(1 / (1 + d), 6) AS score,
               CAST(length(text) AS INTEGER) AS passage_chars
        FROM ranked JOIN documents ON doc_id = vec_id WHERE rank <= 5""",
    "rag_prompt": f"""
        WITH {_TOP},
        held AS (SELECT query_id, text, rank AS place FROM ranked JOIN documents ON doc_id = vec_id WHERE rank <= 3),
        found AS (SELECT query_id, string_agg('[' || place || '] ' || text, chr(10) || chr(10) ORDER BY place) AS context
                  FROM held GROUP BY query_id)
        SELECT query_id, 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || text || chr(10) || 'Answer:' AS prompt
        FROM found JOIN documents ON doc_id = query_id WHERE length(text) BETWEEN 1 AND 2000""",
    "text_retrieval": r"""
        WITH t AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        w AS (SELECT side, id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[^\s\x1c-\x1f\x0b]+')) AS word FROM t),
        n AS (SELECT side, id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 256 AS b, count(*) AS n FROM w GROUP BY ALL),
        counts AS (SELECT side, id, list(coalesce(n.n, 0)::DOUBLE ORDER BY b) AS c
                   FROM (SELECT side, id, unnest(range(256)) AS b FROM t) LEFT JOIN n USING (side, id, b) GROUP BY side, id),
        single AS (SELECT side, id, list_transform(c, lambda x: (x / greatest(sqrt(list_inner_product(c, c)), 1e-12))::FLOAT)::DOUBLE[] AS e FROM counts),
        unit AS (SELECT side, id, list_transform(e, lambda x: x / greatest(sqrt(list_inner_product(e, e)), 1e-12)) AS e FROM single),
        near AS (SELECT q.id AS query_id, c.id AS vec_id, pow(list_distance(q.e, c.e), 2) AS d
                 FROM unit q JOIN unit c ON q.side = 'b' AND c.side = 'd'),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM near)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, 6) AS distance, round(1 / (1 + d), 6) AS score
        FROM ranked WHERE rank <= 10""",
    "vector_store": """
        SELECT row_number() OVER (ORDER BY label, vec_id) - 1 AS vec_id, CAST(length(text) AS INTEGER) AS chars,
               1.0::DOUBLE AS norm, 0 AS entries
        FROM embeddings JOIN documents ON doc_id = vec_id""",
    "vector_writers": """
        SELECT coalesce(lang, 'none') AS batch, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
               CAST(length(text) AS INTEGER) AS chars, count(*) OVER (PARTITION BY lang) AS batch_rows,
               count(*) OVER () AS ids, count(*) OVER () - 1 AS last_id
        FROM documents""",
    "vector_neighbours": f"""
        WITH {_TOP}
        SELECT query_id AS vec_id, round(d, 6) AS distance FROM near WHERE vec_id = query_id + 1""",
    "argmax_label": """
        SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS label FROM embeddings""",
    "predict_request_validation": """
        WITH r AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 0 ELSE len(string_split(text, chr(10))) END AS n FROM conversations)
        SELECT conv_id, turn, CAST(n AS INTEGER) AS n_inputs, 'champion' AS model_version, n BETWEEN 1 AND 64 AS valid FROM r""",
    "scoring_inputs": """
        WITH r AS (SELECT conv_id, turn, string_split(text, chr(10)) AS t FROM conversations)
        SELECT conv_id, turn, CAST(unnest(range(0, len(t))) AS INTEGER) AS position, unnest(t) AS text FROM r""",
    "retrieval_request_validation": """
        WITH r AS (SELECT conv_id, turn, length(text) AS n, CAST(CASE WHEN turn <> 3 THEN turn * 4 ELSE 5 END AS INTEGER) AS top_k,
                          CASE WHEN turn <> 5 THEN (conv_id % 5) * 0.6::DOUBLE ELSE 0.2 END AS temperature FROM conversations)
        SELECT conv_id, turn, top_k, round(temperature, 3) AS temperature,
               n BETWEEN 1 AND 2000 AND top_k BETWEEN 1 AND 20 AND temperature BETWEEN 0 AND 2 AS valid,
               CASE WHEN n NOT BETWEEN 1 AND 2000 THEN 'query' WHEN top_k NOT BETWEEN 1 AND 20 THEN 'top_k'
                    WHEN temperature NOT BETWEEN 0 AND 2 THEN 'temperature' ELSE 'none' END AS problem
        FROM r""",
    "feedback_defaults": """
        SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) ELSE 'unknown' END AS prediction_id,
               json_extract_string(props, '$.k') AS true_label, 'null' AS predicted_label,
               CASE WHEN event_type <> 'signup' THEN event_type ELSE 'api' END AS source
        FROM events""",
    "feedback_log": """
        SELECT CASE WHEN event_type <> 'signup' THEN event_type ELSE 'api' END AS source, count(*) AS records,
               (SELECT count(*) FROM events) AS feedback_rows
        FROM events GROUP BY 1""",
}
ORACLES["indexed_retrieval"] = ORACLES["topk_retrieval"]
