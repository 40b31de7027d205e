"""Exact nearest-vector retrieval for batches of queries, and the prompts built from it."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sluiceway.functions.text import context_block, prompt_text
from sluiceway.functions.vector import l2_normalise, similarity
from sluiceway.operators.ranking import exact_positions

TOP_K = 5
# Query vectors up to this size are sent to every task; more are matched block against block.
BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 32_768
# Distances held at once while one block is searched.
TILE_CELLS = 4_000_000

# ---- embedding ----------------------------------------------------------------------------------


# Words whose places a task remembers at most, and their characters.
KNOWN_WORDS = 250_000
KNOWN_CHARS = 8_000_000
# Bytes and rows of texts whose words a task holds at once, and words of a longer text.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 2048
SLICE_WORDS = 200_000
# Python's white space is that of BETWEEN_WORDS.
_WORD = re.compile(r"\S+")


def _text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first text, texts) for runs of whole texts of at most SLICE_BYTES together; a longer text is alone."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        to = min(to, at + SLICE_ROWS)
        yield at, texts.slice(at, to - at)
        at = to


def _word_lists(texts: pa.Array) -> Iterator[list[list[str]]]:
    """The words of each text; those of one longer text come in several lists."""
    if len(texts) > 1 or not texts[0].is_valid or texts.nbytes <= SLICE_BYTES:
        yield [x.split() if x else [] for x in texts.to_pylist()]
        return
    words = (x.group() for x in _WORD.finditer(texts[0].as_py()))
    while some := list(islice(words, SLICE_WORDS)):
        yield [some]


def hash_embedding(df: DataFrame, text: str = "text", dimensions: int = 256, output: str = "embedding") -> DataFrame:
    """Default embedding: hashed word counts, as a unit vector; without words, or text, all zeros.

    A word's place is the number of its MD5's first eight hex digits, modulo `dimensions`; other engines can
    rebuild it. A task remembers the places of up to KNOWN_WORDS words, and holds the words of one slice of texts.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        chars = 0
        for batch in batches:
            vectors = np.zeros((len(batch), dimensions), dtype=np.float32)
            for at, texts in _text_slices(batch):
                counts = np.zeros((len(texts), dimensions))
                for found in _word_lists(texts):
                    flat = [w for own in found for w in own]
                    if len(known) > KNOWN_WORDS or chars > KNOWN_CHARS:
                        known.clear()
                        chars = 0
                    for w in set(flat) - known.keys():
                        chars += len(w)
                        known[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dimensions
                    row = np.repeat(np.arange(len(found)), [len(own) for own in found])
                    place = np.fromiter(map(known.__getitem__, flat), dtype=np.int64, count=len(flat))
                    counts += np.bincount(row * dimensions + place, minlength=counts.size).reshape(-1, dimensions)
                norms = np.sqrt((counts * counts).sum(axis=1))
                vectors[at : at + len(texts)] = counts / np.where(norms == 0, 1, norms)[:, None]
            borders = np.arange(len(batch) + 1, dtype=np.int32) * dimensions
            yield pa.ListArray.from_arrays(pa.array(borders), pa.array(vectors.ravel()))

    return df.withColumn(output, embed(F.lower(F.col(text))))


def embed_with(
    df: DataFrame, encoder: Callable[[], Callable[[pd.Series], list]], text: str = "text", output: str = "embedding"
) -> DataFrame:
    """Embedding by a user's encoder; `encoder` builds the model once per task, batches come by Arrow."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder()
        for batch in batches:
            matrix = np.asarray(list(model(batch)), dtype=np.float64)
            yield pd.Series(list(_unit(matrix).astype(np.float32)))

    return df.withColumn(output, encode(F.col(text)))


def append_vectors(df: DataFrame, path: str, order: list[str]) -> None:
    """Append text, metadata and unit vectors to the corpus; ids go on from the largest so far.

    `order` names columns that identify a row and give the order of the new ids. A missing metadata
    column means empty maps. One writer at a time: ids are drawn from the stored maximum.
    """
    spark = df.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max("vec_id")).first()[0]
        first = 0 if last is None else last + 1
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        first = 0
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    metadata = F.coalesce(F.col("metadata"), empty) if "metadata" in df.columns else empty
    rows = df.select(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        "text",
        metadata.alias("metadata"),
        l2_normalise(F.col("embedding")).cast("array<float>").alias("embedding"),
    )
    numbered = exact_positions(rows, [], [f"_o{i}" for i in range(len(order))], "_pos")
    numbered.select((F.col("_pos") + first).alias("vec_id"), "embedding", "text", "metadata").write.mode("append").parquet(path)


# ---- search -------------------------------------------------------------------------------------


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.maximum(norms, 1e-12)[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray, dimensions: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _unit(np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dimensions))


def _first_k(query: np.ndarray, vec: np.ndarray, dist: np.ndarray, k: int):
    """The k nearest rows of each query, ties by vector id."""
    # Text ids are compared by their place in order.
    tie = np.unique(vec, return_inverse=True)[1] if vec.dtype == object else vec
    order = np.lexsort((tie, dist, query))
    query, vec, dist = query[order], vec[order], dist[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], vec[place < k], dist[place < k]


def _nearest(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query position, vector id, squared distance) of the k nearest vectors of each query.

    A matrix product proposes every vector within rounding of the k-th distance; their distances are
    then computed directly, so equal vectors tie exactly.
    """
    found = []
    tile = max(1, TILE_CELLS // max(1, len(vectors)))
    squares = np.einsum("ij,ij->i", vectors, vectors)
    for start in range(0, len(queries), tile):
        q = queries[start : start + tile]
        rough = np.einsum("ij,ij->i", q, q)[:, None] + squares[None, :] - 2 * (q @ vectors.T)
        if k < len(vectors):
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + 1e-9
            qi, vi = np.nonzero(rough <= limit)
        else:
            qi, vi = np.nonzero(np.ones_like(rough, dtype=bool))
        dist = np.empty(len(qi))
        step = max(1, TILE_CELLS // queries.shape[1])
        for s in range(0, len(qi), step):
            gap = q[qi[s : s + step]] - vectors[vi[s : s + step]]
            dist[s : s + step] = np.einsum("ij,ij->i", gap, gap)
        found.append(_first_k(qi + start, ids[vi], dist, k))
    return tuple(np.concatenate(part) for part in zip(*found))


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _hit_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    """Hits keep the ids' own types."""
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("vec_id", corpus.schema["vec_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _hit_batch(query_ids: np.ndarray, query: np.ndarray, vec: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[query]), pa.array(vec), pa.array(dist)], names=["query_id", "vec_id", "distance"]
    )


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    top_k: int = TOP_K,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, distance, score of the `top_k` nearest vectors, exhaustively.

    Vectors are normalised, distance is squared L2, ties go to the smaller vec_id; a corpus smaller
    than `top_k` gives fewer rows. `query_id` and `vec_id`, integers or texts, identify their rows. Each task keeps just
    the k best per query it has seen, no pair of vectors becomes a row, and the last rank limit is
    again applied before its shuffle. Query vectors are measured first: a small batch goes to
    every task, a large one is cut into blocks that meet the blocks of the corpus.
    """
    q = queries.where("embedding is not null").select("query_id", "embedding")
    c = corpus.where("embedding is not null").select("vec_id", "embedding")
    count, shortest, longest = q.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if not count:
        ids = [T.StructField(n, df.schema[n].dataType) for n, df in (("query_id", q), ("vec_id", c))]
        numbers = [T.StructField("distance", T.DoubleType()), T.StructField("score", T.DoubleType())]
        return q.sparkSession.createDataFrame([], T.StructType([ids[0], T.StructField("rank", T.IntegerType()), ids[1], *numbers]))
    if shortest != longest:
        raise ValueError("query vectors differ in length")
    fits = F.when(F.size("embedding") == longest, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"corpus vector is not of length {longest}")).cast(c.schema["embedding"].dataType)
    )
    c = c.withColumn("embedding", fits)
    if count * longest * 8 <= broadcast_bytes:
        hits = _search_broadcast(q, c, top_k, longest)
    else:
        hits = _search_blocks(q, c, top_k, longest, count, block_rows)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return (
        hits.withColumn("rank", rank)
        .where(F.col("rank") <= top_k)
        .select("query_id", "rank", "vec_id", "distance", similarity(F.col("distance")).alias("score"))
    )


def _search_broadcast(queries: DataFrame, corpus: DataFrame, k: int, dimensions: int) -> DataFrame:
    table = queries.toArrow()
    shared = queries.sparkSession.sparkContext.broadcast(
        (_ids(table["query_id"]), _matrix(table["embedding"], dimensions))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors = shared.value
        best = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            part = _nearest(vectors, _matrix(batch.column("embedding"), dimensions), _ids(batch.column("vec_id")), k)
            best = part if best is None else _first_k(*(np.concatenate(p) for p in zip(best, part)), k)
        if best is not None:
            yield _hit_batch(query_ids, *best)

    return corpus.mapInArrow(search, _hit_schema(queries, corpus))


def _search_blocks(queries: DataFrame, corpus: DataFrame, k: int, dimensions: int, count: int, block_rows: int) -> DataFrame:
    q_blocks = math.ceil(count / block_rows)
    c_blocks = max(1, math.ceil(corpus.count() / block_rows))

    def block(column: str, blocks: int):
        return F.pmod(F.xxhash64(column), F.lit(blocks))

    left = queries.withColumn("qb", block("query_id", q_blocks)).withColumn(
        "cb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(c_blocks - 1).cast("bigint")))
    )
    right = corpus.withColumn("cb", block("vec_id", c_blocks)).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(q_blocks - 1).cast("bigint")))
    )

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows == 0 or b.num_rows == 0:
            none = {"query_id": a["query_id"].slice(0, 0), "vec_id": b["vec_id"].slice(0, 0), "distance": pa.array([], pa.float64())}
            return pa.table(none)
        hits = _nearest(
            _matrix(a["embedding"], dimensions), _matrix(b["embedding"], dimensions), _ids(b["vec_id"]), k
        )
        return pa.Table.from_batches([_hit_batch(_ids(a["query_id"]), *hits)])

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(search, _hit_schema(queries, corpus))


# ---- passages and prompts -----------------------------------------------------------------------


def searchable(corpus: DataFrame, passages: DataFrame) -> DataFrame:
    """The vectors that have a passage. Search these, so that no hit is spent on a vector without one."""
    return corpus.join(passages.select("vec_id"), "vec_id", "left_semi")


def with_passages(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """Hits with the text and metadata of their vectors; `passages` has vec_id, text and maybe metadata.

    An equi-join that drops hits without a passage; see `searchable`. A passage wanted by very many queries is a hot
    key on the hits' side, which the adaptive skew join splits.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    metadata = F.coalesce(F.col("metadata"), empty) if "metadata" in passages.columns else empty
    return hits.join(passages.select("vec_id", "text", metadata.alias("metadata")), "vec_id")


def build_prompts(questions: DataFrame, sources: DataFrame) -> DataFrame:
    """query_id, sources, context, prompt per question.

    `questions` has query_id and query, `sources` the passages found. At most top_k passages per
    query are gathered. A question without any gets an empty context.
    """
    gathered = (
        sources.groupBy("query_id")
        .agg(F.collect_list(F.struct("rank", "text", "score", "metadata")).alias("s"))
        .withColumn("s", F.array_sort("s", lambda a, b: a["rank"] - b["rank"]))
    )
    context = F.coalesce(context_block(F.transform("s", lambda x: F.struct(x["rank"].alias("rank"), x["text"].alias("text")))), F.lit(""))
    return questions.join(gathered, "query_id", "left").select(
        "query_id",
        F.transform("s", lambda x: F.struct(x["text"].alias("text"), x["score"].alias("score"), x["metadata"].alias("metadata"))).alias("sources"),
        context.alias("context"),
        prompt_text(context, F.col("query")).alias("prompt"),
    )


def answer_with(prompts: DataFrame, generator: Callable[[], Callable[[pd.Series], list]]) -> DataFrame:
    """Add `answer` by a user's generator, built once per task."""

    @F.pandas_udf(T.StringType())
    def generate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = generator()
        for batch in batches:
            yield pd.Series(list(model(batch)))

    return prompts.withColumn("answer", generate(F.col("prompt")))
