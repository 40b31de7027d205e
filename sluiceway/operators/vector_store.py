"""A corpus of vectors that several writers extend at once.

A store is a folder with `vectors/batch=<number>`, `ledger/<number>.json` and `written/<number>.json`. A writer brings a batch under a key of its
own choice. It numbers the rows from 0, then claims the next range of ids: a ledger entry holds the batch's key, its first
id and its rows, and comes into being whole and only if no other writer made the entry of that number before; whoever
comes second looks again. Then the rows are written with their ids, and marked as written.

So ids are unique and gapless whoever writes when, and a batch brought twice is stored once: a known key keeps the range it
claimed, and a batch whose writer died between claim and write is filled by the next call with its key. Until then its
range is pending, and readers pass it over. Two calls with one key at the same time claim once, but both may write the
same rows to the same folder: run one job per key at a time.

Entries are one small file per batch and pass the driver; rows do not. Null texts and embeddings are stored as they are, an
empty batch claims an empty range. Columns beside text, metadata and embedding are not stored.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions.vector import l2_normalise
from sluiceway.operators.ranking import exact_positions
from sluiceway.operators.retrieval import hash_embedding
from sluiceway.session import to_scratch_table

_ENTRY = "number bigint, key string, first bigint, rows bigint"
_STORED = "vec_id bigint, embedding array<float>, text string, metadata map<string,string>"


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Make a file with this content, whole or not at all; False if the path is taken.

    A finished file gets its name by a hard link on a local or mounted file system, elsewhere by Hadoop's rename,
    which on a file system like HDFS does not replace a file. Object stores without such a rename cannot hold a ledger.
    """
    temporary = f"{os.path.dirname(path)}/_new-{uuid.uuid4().hex}"
    context = spark.sparkContext
    target, source = (context._jvm.org.apache.hadoop.fs.Path(p) for p in (path, temporary))
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    if files.getScheme() == "file":
        target_path, source_path = (unquote(urlparse(p).path) if p.startswith("file:") else p for p in (path, temporary))
        os.makedirs(os.path.dirname(target_path), exist_ok=True)
        with open(source_path, "w", encoding="utf-8") as out:
            out.write(content)
        try:
            os.link(source_path, target_path)
        except FileExistsError:
            return False
        finally:
            os.unlink(source_path)
        return True
    files.mkdirs(target.getParent())
    out = files.create(source, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    made = files.rename(source, target)
    if not made:
        files.delete(source, False)
    return made


class VectorStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _marks(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/{folder}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def entries(self) -> DataFrame:
        """The claimed ranges: number, key, first, rows."""
        return self._marks("ledger", _ENTRY)

    def _folder(self, number: int) -> str:
        return f"{self.path}/vectors/batch={number}"

    def _written(self) -> set[int]:
        return {r.number for r in self._marks("written", "number bigint").collect()}

    def pending(self) -> list[str]:
        """Keys of the batches that claimed ids and are not written."""
        written = self._written()
        return [e.key for e in self.entries().orderBy("number").collect() if e.number not in written]

    def read(self) -> DataFrame:
        """vec_id, embedding, text, metadata of the written batches."""
        folders = [self._folder(number) for number in sorted(self._written())]
        return self.spark.read.schema(_STORED).parquet(*folders) if folders else self.spark.createDataFrame([], _STORED)

    def _claim(self, key: str, rows: int):
        while True:
            known = self.entries().where(F.col("key") == key).first()
            if known is not None:
                if known.rows != rows:
                    raise ValueError(f"batch {key!r} had {known.rows} rows before, now it has {rows}")
                return known
            last = self.entries().orderBy(F.desc("number")).first()
            number, first = (0, 0) if last is None else (last.number + 1, last.first + last.rows)
            entry = {"number": number, "key": key, "first": first, "rows": rows}
            create_once(self.spark, f"{self.path}/ledger/{number:012d}.json", json.dumps(entry))
            # Made or found taken: the ledger says whose it is.

    def append(self, df: DataFrame, key: str, order: list[str]) -> int:
        """Store a batch (text, embedding, maybe metadata) under its key; the first id of its range.

        `order` names columns that identify a row and give the order of the ids. Vectors are stored as unit vectors;
        a missing metadata column or value means empty maps. A key whose rows were counted differently before is an error.
        """
        empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
        rows = df.select(
            *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
            "text",
            (F.coalesce("metadata", empty) if "metadata" in df.columns else empty).alias("metadata"),
            l2_normalise(F.col("embedding")).cast("array<float>").alias("embedding"),
        )
        # Stored, so that what is counted is what is written.
        numbered = to_scratch_table(exact_positions(rows, [], [f"_o{i}" for i in range(len(order))], "_pos"), "batch")
        entry = self._claim(key, numbered.count())
        if entry.number not in self._written():
            placed = numbered.select((F.col("_pos") + entry.first).alias("vec_id"), "embedding", "text", "metadata")
            placed.write.mode("overwrite").parquet(self._folder(entry.number))
            create_once(self.spark, f"{self.path}/written/{entry.number:012d}.json", json.dumps({"number": entry.number}))
        return entry.first

    def append_texts(self, df: DataFrame, key: str, order: list[str], embed: Callable[[DataFrame], DataFrame] = hash_embedding) -> int:
        """Embed the texts and store them in one step."""
        return self.append(embed(df), key, order)
