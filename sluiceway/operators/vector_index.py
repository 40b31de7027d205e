"""A stored cell index of vectors, and exact search that skips what cannot hold a hit.

Vectors are stored by cell (their nearest centre) and, inside a cell, by their distance to the centre. For a
query at distance d from a centre, the triangle inequality keeps every vector at distance r from that centre
at least |d - r| away. Searching takes two scans: the first looks only into the cells around each query
until they hold k vectors, which gives a limit that the k-th hit cannot exceed; the second looks at the
vectors whose bound doesn't exceed it. Queries travel to the vectors in parts of a bounded size; vectors are
never shuffled or copied for a search.

Where bounds exclude little (noise in many dimensions), every query meets every vector: work that grows with their
product. A product in single precision then proposes what may be within the limit, distances are computed directly in
double precision, and the limit falls as a task finds nearer vectors. A task holds a part of the queries, their k best so
far and as many hits again; the driver holds a part and one bit per query and cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from sluiceway.functions.vector import similarity
from sluiceway.operators.retrieval import TILE_CELLS, TOP_K, _first_k, _hit_batch, _hit_schema, _ids, _matrix, _nearest

# Centres at most, rows from which they are found at most, and rounds to find them.
MAX_CELLS = 1024
SAMPLE_ROWS = 50_000
ROUNDS = 8
# Query vectors that travel to the tasks at once.
PART_BYTES = 64 << 20
# Rows of a stored file at most; smaller corpora are so many files of so many rows at least, as files are scanned in parallel.
FILE_ROWS = 200_000
FILES = 64
LEAST_FILE_ROWS = 8192
# Queries whose cells are looked up at once, a multiple of eight.
LOOKUP_ROWS = 8192
# Bounds are sums and roots of rounded numbers.
SLACK = 1e-7


def centres_of(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of a sample by Lloyd's rounds from evenly picked rows; empty cells keep their centre."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(np.int64)].copy()
    for _ in range(rounds):
        cell, _ = _closest(sample, centres)
        n = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centres


def _closest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, distance to it) of each vector."""
    cell = np.empty(len(vectors), dtype=np.int64)
    for a in range(0, len(vectors), 4096):
        part = vectors[a : a + 4096]
        cell[a : a + 4096] = ((centres * centres).sum(axis=1)[None, :] - 2 * part @ centres.T).argmin(axis=1)
    return cell, np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))


def build_index(corpus: DataFrame, path: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
    """Store an index of `corpus` (vec_id, embedding; rows without a vector are left out) below `path`.

    Centres come from a sample of about `sample_rows` rows; every vector is assigned in a scan. The stored
    rows are laid out by ranges of (cell, distance), so a cell that holds a third of all vectors is many files.
    """
    spark = corpus.sparkSession
    rows = corpus.where("embedding IS NOT NULL").select("vec_id", "embedding")
    count, shortest, longest = rows.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if count and shortest != longest:
        raise ValueError("vectors differ in length")
    dimensions = longest or 1
    by_hash = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / max(1, count)))
    sample = rows.where(by_hash).orderBy(F.xxhash64("vec_id", "embedding")).select("embedding").toArrow()["embedding"]
    if not len(sample):
        sample = rows.limit(1).select("embedding").toArrow()["embedding"]
    wanted = cells or min(MAX_CELLS, max(1, math.isqrt(count)))
    centres = centres_of(_matrix(sample, dimensions), wanted) if count else np.zeros((0, dimensions))
    spread = spark.sparkContext.broadcast(centres)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, gap = _closest(_matrix(batch["embedding"], dimensions), spread.value)
                yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(gap), *batch.columns], ["cell", "gap", "vec_id", "embedding"])

    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType()), *rows.schema.fields])
    parts = max(1, math.ceil(count / FILE_ROWS), min(FILES, math.ceil(count / LEAST_FILE_ROWS)))
    laid = rows.mapInArrow(placed, schema).repartitionByRange(parts, "cell", "gap", "vec_id").sortWithinPartitions("cell", "gap", "vec_id")
    laid.write.mode("overwrite").parquet(f"{path}/vectors")
    stored = spark.read.schema(schema).parquet(f"{path}/vectors")
    radii = {r.cell: (r.n, r.low, r.high) for r in stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("low"), F.max("gap").alias("high")).collect()}
    table = [(i, [float(x) for x in c], *radii.get(i, (0, 0.0, 0.0))) for i, c in enumerate(centres)]
    spark.createDataFrame(table, "cell int, centre array<double>, n long, low double, high double").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


class _Best:
    """The k nearest vectors of each query so far, and the squared distance that a further hit cannot exceed."""

    def __init__(self, limit: np.ndarray, k: int) -> None:
        self.limit, self.k = limit.copy(), k
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.new = 0

    def add(self, query: np.ndarray, vec: np.ndarray, dist: np.ndarray) -> None:
        if len(query):
            self.found.append((query, vec, dist))
            self.new += len(query)
            if self.new > max(1 << 16, len(self.limit) * self.k):
                self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        self.found = [_first_k(*(np.concatenate(x) for x in zip(*self.found, strict=True)), self.k)]
        self.new = 0
        query, _, dist = self.found[0]
        last = np.flatnonzero(np.append(query[1:] != query[:-1], True))
        full = last[np.diff(np.append(-1, last)) == self.k]  # rows go by query and rising distance
        self.limit[query[full]] = np.minimum(self.limit[query[full]], dist[full])


def _raised(queries: np.ndarray) -> np.ndarray:
    """Queries in single precision with a last 1, for a product with `_lowered` vectors."""
    return np.concatenate([queries, np.ones((len(queries), 1))], axis=1).astype(np.float32)


def _lowered(vectors: np.ndarray) -> np.ndarray:
    """Vectors in single precision with a last -v.v / 2."""
    return np.concatenate([vectors, -np.einsum("ij,ij->i", vectors, vectors)[:, None] / 2], axis=1).astype(np.float32)


def _within(queries: np.ndarray, raised: np.ndarray, looking: np.ndarray, vectors: np.ndarray, ids: np.ndarray, best: _Best) -> None:
    """Give `best` the vectors that the `looking` queries, all of finite limits, have within their limits.

    |q - v|^2 <= limit means q.v - v.v / 2 >= (q.q - limit) / 2; the left side is one product, less its rounding.
    """
    lowered = _lowered(vectors)
    slack = 2.0 ** -23 * (queries.shape[1] + 8)
    tile, step = max(1, TILE_CELLS // len(vectors)), max(1, TILE_CELLS // (4 * queries.shape[1]))
    for start in range(0, len(looking), tile):
        own = looking[start : start + tile]
        q = queries[own]
        bar = (np.einsum("ij,ij->i", q, q) - best.limit[own]) / 2
        at = np.flatnonzero(raised[own] @ lowered.T >= (bar - slack).astype(np.float32)[:, None])
        if len(at) * 16 > len(own) * len(vectors):  # crowded within that rounding
            exact = q @ vectors.T - np.einsum("ij,ij->i", vectors, vectors)[None, :] / 2
            at = np.flatnonzero(exact >= bar[:, None] - 1e-9)
        for s in range(0, len(at), step):
            qi, vi = np.divmod(at[s : s + step], len(vectors))
            gap = q[qi] - vectors[vi]
            dist = np.einsum("ij,ij->i", gap, gap)
            near = dist <= best.limit[own[qi]]
            best.add(own[qi[near]], ids[vi[near]], dist[near])


def _needed(cells: np.ndarray, gaps: np.ndarray, ids: np.ndarray, embedding: np.ndarray, k: int) -> np.ndarray:
    """Which rows can be hits: of equal vectors in a row, by rising id, only the first k, as ties go to the smaller id."""
    same = (cells[1:] == cells[:-1]) & (gaps[1:] == gaps[:-1]) & (ids[1:] >= ids[:-1])
    same[same] = (embedding[1:][same] == embedding[:-1][same]).all(axis=1)
    begin = np.flatnonzero(np.append(True, ~same))
    return np.arange(len(cells)) - np.repeat(begin, np.diff(np.append(begin, len(cells)))) < k


def _search(vectors: DataFrame, asked: tuple, k: int, dimensions: int, schema: T.StructType) -> DataFrame:
    """Hits of one scan. `asked`: query ids, vectors, centres, limits per query, and per cell the bits of the queries that look into it."""
    spread = vectors.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, centres, limit, lookers = spread.value
        best, raised = _Best(limit, k), _raised(queries)
        squares = np.einsum("ij,ij->i", queries, queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, gaps, ids = batch["cell"].to_numpy(), batch["gap"].to_numpy(), _ids(batch["vec_id"])
            embedding = _matrix(batch["embedding"], dimensions)
            needed = _needed(cells, gaps, ids, embedding, k)
            if not needed.all():
                cells, gaps, ids, embedding = cells[needed], gaps[needed], ids[needed], embedding[needed]
            # A batch may go on in another file, not always the next one in order.
            borders = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]) | (gaps[1:] < gaps[:-1])))
            for a, b in zip(borders, np.append(borders[1:], len(cells)), strict=True):
                looking = np.flatnonzero(np.unpackbits(lookers[cells[a]], count=len(queries)))
                if not len(looking):
                    continue
                centre = centres[cells[a]]
                along = (queries @ centre)[looking] if len(looking) * 4 > len(queries) else queries[looking] @ centre
                d = np.sqrt(np.maximum(squares[looking] + centre @ centre - 2 * along, 0))
                reach = np.sqrt(best.limit[looking]) + SLACK
                near = (d - gaps[b - 1] <= reach) & (gaps[a] - d <= reach)  # the run's gaps rise
                looking, d, reach = looking[near], d[near], reach[near]
                if not len(looking):
                    continue
                low = a + int(np.searchsorted(gaps[a:b], (d - reach).min(), side="left"))
                high = a + int(np.searchsorted(gaps[a:b], (d + reach).max(), side="right"))
                if low >= high:
                    continue
                limited = np.isfinite(best.limit[looking])
                if not limited.all():
                    free = looking[~limited]
                    part, vec, dist = _nearest(queries[free], embedding[low:high], ids[low:high], k)
                    best.add(free[part], vec, dist)
                    best.settle()
                if limited.any():
                    _within(queries, raised, looking[limited], embedding[low:high], ids[low:high], best)
        best.settle()
        if best.found:
            yield _hit_batch(query_ids, *best.found[0])

    return vectors.mapInArrow(search, schema)


def nearest_indexed(spark: SparkSession, queries: DataFrame, path: str, top_k: int = TOP_K, part_bytes: int = PART_BYTES) -> DataFrame:
    """query_id, rank, vec_id, distance, score of the `top_k` nearest stored vectors; the same rows as `nearest` gives.

    Queries without a vector get no rows, a corpus of fewer vectors fewer rows, ties go to the smaller vec_id.
    """
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    vectors = spark.read.parquet(f"{path}/vectors")
    wanted = queries.where("embedding IS NOT NULL").select("query_id", "embedding")
    schema = _hit_schema(wanted, vectors)
    empty = spark.createDataFrame([], schema)
    centres = np.array([c.centre for c in cells])
    size, low, high = (np.array([c[x] for c in cells]) for x in ("n", "low", "high"))
    hits = []
    if len(cells):
        dimensions = centres.shape[1]
        count, shortest, longest = wanted.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
        if count and not shortest == longest == dimensions:
            raise ValueError("query vectors differ in length from the stored ones")
        parts = max(1, math.ceil(count * dimensions * 8 / part_bytes))
        for p in range(parts if count else 0):
            own = wanted.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == p).toArrow()
            if not len(own):
                continue
            ids, q = _ids(own["query_id"]), _matrix(own["embedding"], dimensions)
            everything = np.full(len(q), np.inf)
            home = _looked_up(q, centres, lambda d, at: _home_cells(d, size, top_k))
            first = _search(vectors, (ids, q, centres, everything, home), top_k, dimensions, schema)
            limit = _limits(first, own["query_id"], top_k)
            reach = np.sqrt(limit)[:, None] + SLACK
            may = _looked_up(
                q, centres, lambda d, at: (size > 0)[None, :] & (d - high[None, :] <= reach[at]) & (low[None, :] - d <= reach[at])
            )
            hits.append(_search(vectors, (ids, q, centres, limit, may), top_k, dimensions, schema))
    found = hits[0] if hits else empty
    for more in hits[1:]:
        found = found.union(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top_k).select("query_id", "rank", "vec_id", "distance", similarity(F.col("distance")).alias("score"))


def _home_cells(d: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """For queries at distances `d` from the centres, the nearest cells that hold k vectors together."""
    d = np.where(size > 0, d, np.inf)
    home = np.zeros(d.shape, dtype=bool)
    home[np.arange(len(d)), d.argmin(axis=1)] = True
    more = np.flatnonzero(size[d.argmin(axis=1)] < k)
    order = np.argsort(d[more], axis=1)
    until = (np.cumsum(size[order], axis=1) >= k).argmax(axis=1)
    until = np.where(size.sum() >= k, until, len(size) - 1)
    home[more[:, None], order] = np.arange(len(size))[None, :] <= until[:, None]
    return home


def _looked_up(queries: np.ndarray, centres: np.ndarray, cells_of: Callable[[np.ndarray, slice], np.ndarray]) -> np.ndarray:
    """Per cell the bits of the queries that look into it, as `cells_of` has it for the distances of a slice of queries."""
    bits = []
    for a in range(0, len(queries), LOOKUP_ROWS):
        at = slice(a, a + LOOKUP_ROWS)
        q = queries[at]
        squares = (q * q).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :]
        bits.append(_lookers(cells_of(np.sqrt(np.maximum(squares - 2 * q @ centres.T, 0)), at)))
    return np.concatenate(bits, axis=1)


def _lookers(pairs: np.ndarray) -> np.ndarray:
    return np.packbits(pairs.T, axis=1)


def _limits(hits: DataFrame, ids: pa.ChunkedArray, k: int) -> np.ndarray:
    """Squared distance that the k-th hit of each query cannot exceed; infinite for those with fewer hits."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    worst = hits.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", "distance").toArrow()
    known = dict(zip(worst["query_id"].to_pylist(), worst["distance"].to_pylist(), strict=True))
    return np.array([known.get(i, np.inf) for i in ids.to_pylist()])
