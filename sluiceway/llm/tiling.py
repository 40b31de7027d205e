"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are word sequences (A-Z lower-cased). Shared seeds, the hashes of MIN_TILE
consecutive words, join documents with items. For each such pair the longest matches of words not marked yet
are marked again and again (running Karp-Rabin: windows of the search length are hashed, equal ones are
grown; the length is halved down to MIN_TILE, or restarted when a match is longer), so tiles never overlap
and moved passages are found whatever their order. A document is contaminated by an item if the tiles
cover at least `coverage` of the item's words.

Items shorter than MIN_TILE words match as a whole sequence. Null texts and items without words match
nothing. Items are sent to the tasks in parts of at most `part_bytes`, one pass over the documents each, so
what is broadcast is bounded whatever the benchmark's size. Repeated items and rows are kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm import textscan

MIN_TILE = 5
COVERAGE = 0.5
PART_BYTES = 16 << 20
SCHEMA = "doc_id long, text_key long, item_id long, item_words long, covered_words long, tiles array<struct<doc_word: long, item_word: long, words: long>>"
_TILES = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))


def _matches(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least `length` unmarked words: (words, place in a, place in b)."""
    if min(len(a), len(b)) < length:
        return []

    def open_windows(free: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(free)])
        return total[length:] - total[:-length] == length

    in_a, in_b = np.flatnonzero(open_windows(free_a)), np.flatnonzero(open_windows(free_b))
    hash_a, hash_b = textscan.windows(a, length)[in_a], textscan.windows(b, length)[in_b]
    order = np.argsort(hash_b, kind="stable")
    low = np.searchsorted(hash_b[order], hash_a, side="left")
    high = np.searchsorted(hash_b[order], hash_a, side="right")
    found = []
    for i in np.flatnonzero(high > low).tolist():
        x = int(in_a[i])
        for y in in_b[order[low[i] : high[i]]].tolist():
            if x and y and free_a[x - 1] and free_b[y - 1] and a[x - 1] == b[y - 1]:
                continue  # part of the match that begins one word earlier
            n = length
            while x + n < len(a) and y + n < len(b) and free_a[x + n] and free_b[y + n] and a[x + n] == b[y + n]:
                n += 1
            found.append((n, x, y))
    return found


def tile(a: np.ndarray, b: np.ndarray, shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in a, place in b, words) of two hash sequences, longest first; ties go to the first places."""
    free_a, free_b = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
    tiles = []
    length = max(shortest, min(len(a), len(b)) // 2)
    while True:
        found = _matches(a, b, free_a, free_b, length)
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for n, x, y in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if free_a[x : x + n].all() and free_b[y : y + n].all():
                free_a[x : x + n] = free_b[y : y + n] = False
                tiles.append((x, y, n))
            elif n > length:
                # A longer match lost words to another tile; what is left of it is found in the next round.
                found = None
                break
        if found is None:
            continue
        if length == shortest:
            return tiles
        length = max(shortest, length // 2)


def _items(benchmark: DataFrame, part_bytes: int) -> list[DataFrame]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = math.ceil(total / part_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    return [rows.where(part == i) for i in range(parts)]


def _index(items: pa.Table, shortest: int) -> tuple:
    """(item ids, their words, sorted seeds, the item of each seed, items shorter than a seed)."""
    names = items["item_id"].to_pylist()
    sequences = []
    for _, data, offsets in textscan.slices(items["text"], textscan.SMALL_SLICE_BYTES):
        found = textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES)
        sequences += [found.hash[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    seeds, owners = [], []
    for i, words in enumerate(sequences):
        own = textscan.windows(words, shortest) if len(words) >= shortest else np.zeros(0, dtype=np.uint64)
        seeds.append(own)
        owners.append(np.full(len(own), i))
    seed, owner = np.concatenate([*seeds, np.zeros(0, dtype=np.uint64)]), np.concatenate([*owners, np.zeros(0, dtype=np.int64)])
    order = np.argsort(seed, kind="stable")
    small = [i for i, words in enumerate(sequences) if 0 < len(words) < shortest]
    return names, sequences, seed[order], owner[order], small


def _hits(texts: pa.Array, index: tuple, coverage: float, shortest: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(number of the text, number of the item, tiles) of contaminated texts."""
    names, sequences, seed, owner, small = index
    sizes = np.array([len(x) for x in sequences])
    for at, data, offsets in textscan.slices(texts, textscan.SMALL_SLICE_BYTES):
        found = textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES)
        pairs = set()
        if len(seed):
            windows = textscan.windows(found.hash, shortest)
            low = np.searchsorted(seed, windows)
            hit = found.doc[: len(windows)] == found.doc[shortest - 1 :]
            hit &= seed[np.minimum(low, len(seed) - 1)] == windows
            docs, low = np.unique(np.stack([found.doc[: len(windows)][hit], low[hit]]), axis=1)
            times = np.searchsorted(seed, seed[low], side="right") - low if len(low) else low
            shift = np.repeat(low - np.cumsum(times) + times, times)
            meets, n = np.unique(np.repeat(docs, times) * len(names) + owner[shift + np.arange(len(shift))], return_counts=True)
            # A seed's place is worth `shortest` words at most: pairs that cannot reach the coverage are left.
            pairs = {divmod(m, len(names)) for m in meets[n * shortest >= coverage * sizes[meets % len(names)]].tolist()}
        for i in small:
            windows = textscan.windows(found.hash, len(sequences[i]))
            inside = found.doc[: len(windows)] == found.doc[len(sequences[i]) - 1 :]
            same = inside & (windows == textscan.windows(sequences[i], len(sequences[i]))[0])
            pairs |= {(d, i) for d in found.doc[: len(windows)][same].tolist()}
        for d, i in sorted(pairs):
            tiles = tile(found.hash[found.first[d] : found.first[d + 1]], sequences[i], min(shortest, len(sequences[i])))
            if sum(n for _, _, n in tiles) >= coverage * len(sequences[i]):
                yield at + d, i, tiles


def contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = MIN_TILE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """One row per document and item that it covers: doc_id, text_key, item_id, words, covered words and the tiles."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for part in _items(benchmark, part_bytes):
        spread = docs.sparkSession.sparkContext.broadcast(_index(part.toArrow(), shortest))
        out = out.union(rows.mapInArrow(_report(spread, coverage, shortest), SCHEMA))
    return out


def _report(spread: Broadcast, coverage: float, shortest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sequences = spread.value[:2]
        for batch in batches:
            ids, keys, out = batch["doc_id"].to_pylist(), batch["text_key"].to_pylist(), []
            for d, i, tiles in _hits(batch["text"], spread.value, coverage, shortest):
                spans = [{"doc_word": x, "item_word": y, "words": n} for x, y, n in tiles]
                out.append((ids[d], keys[d], names[i], len(sequences[i]), sum(n for _, _, n in tiles), spans))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), _TILES)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "text_key", "item_id", "item_words", "covered_words", "tiles"],
            )

    return textscan.freeing(searched)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = MIN_TILE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The documents, with all their columns, that no item contaminates; nothing is shuffled."""
    for part in _items(benchmark, part_bytes):
        spread = docs.sparkSession.sparkContext.broadcast(_index(part.toArrow(), shortest))
        docs = docs.mapInArrow(_filter(spread, coverage, shortest), docs.schema)
    return docs


def _filter(spread: Broadcast, coverage: float, shortest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textscan.parts(batch):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[d for d, _, _ in _hits(part["text"], spread.value, coverage, shortest)]] = False
                yield part.filter(pa.array(keep))

    return textscan.freeing(kept)
