"""Whole-corpus statistics brought to every document, without a broadcast.

Documents are dealt into blocks of bounded size. A block asks for what it needs (distinct hashes, summed
within the block); the questions of all blocks meet in buckets by hash range; a bucket answers each block
in the order of its question. So a frequent word is one entry per block and no group grows with the corpus.
The texts are shuffled once: asking and reading the answers share that exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BYTES = 16 << 20


def in_blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(documents with `block`, number of blocks). Copies of a row are spread over blocks by where they lie."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64(*docs.columns, F.spark_partition_id()), F.lit(n)).cast("int")
    return docs.withColumn("block", block).repartition(n, "block"), n


def in_compressed_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block and rows, number of blocks), as `in_blocks`, but texts travel in less room.

    A row holds what one Arrow batch had of one block, compressed; `unpacked` gives the documents again.
    """
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64(*docs.columns, F.spark_partition_id()), F.lit(n)).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("block").to_numpy()
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.diff(own[order], prepend=-1))
            rows = pa.Table.from_batches([batch]).drop_columns(["block"])
            for places in np.split(order, starts[1:]) if len(order) else []:
                sink = pa.BufferOutputStream()
                part = rows.take(pa.array(places))
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(part)
                yield pa.record_batch({"block": pa.array([own[places[0]]], pa.int32()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return docs.withColumn("block", block).mapInArrow(pack, "block int, rows binary").repartition(n, "block"), n


def unpacked(table: pa.Table) -> pa.Table:
    """The rows of a block from `in_compressed_blocks`; there is at least one."""
    return pa.concat_tables(pa.ipc.open_stream(rows.as_buffer()).read_all() for chunk in table["rows"].chunks for rows in chunk)


def cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted hashes begins, and the end; buckets are ranges of equal width."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def ask(docs: DataFrame, question: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """One question table per block; `question` returns rows with `bucket` and `block`."""
    return docs.groupBy("block").applyInArrow(question, schema)


def answer(questions: DataFrame, reply: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Rows for blocks from each bucket's questions."""
    return questions.groupBy("bucket").applyInArrow(reply, schema)


def finish(docs: DataFrame, answers: DataFrame, read: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Bring each block's documents and answers together."""
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, schema)


def doc_text(doc_id: Column) -> Column:
    """doc_id as text, a missing one as the empty text; what held-out rules hash."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_text(doc_id)) % F.lit(modulus)
