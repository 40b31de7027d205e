"""Words, shingles and their hashes for whole Arrow batches at once.

A batch of texts is cut into slices of whole documents. Inside a slice one pass over the bytes finds all
words; a prefix sum of byte * P^position gives every word's polynomial hash as a difference (P is odd, so
P^-position exists modulo 2^64), which is then mixed. No Python runs per word.

Words are `[^\\x20\\x09-\\x0D]+`; A-Z are lower-cased. All bytes concerned are ASCII, so UTF-8 stays whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
# The same for the steps of the pipeline, which share their executors' memory with what earlier ones left.
SMALL_SLICE_BYTES = 1 << 19
PART_ROWS = 1000
_P = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def freeing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work`, a function for mapInArrow, without freed batches left in Arrow's pool.

    Workers outlive their tasks: what the pool keeps counts beside all later stages, also those that run no Python.
    """

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def taken() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                pa.default_memory_pool().release_unused()

        yield from work(taken())
        pa.default_memory_pool().release_unused()

    return freed


def parts(batch: pa.RecordBatch, rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most `rows` rows, so that what is made of one is small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """P^k and P^-k for all k below a size; only the last size is kept, and nothing of it travels with a job."""

    def __init__(self) -> None:
        self.size, self.kept = 0, None

    def __reduce__(self) -> tuple:
        return _Powers, ()

    def __call__(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        def of(base: int) -> np.ndarray:
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        if self.size != size:
            self.size, self.kept = size, (of(_P), of(pow(_P, -1, 1 << 64)))
        return self.kept


_powers = _Powers()


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of binary texts, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets of the texts in them) for runs of whole texts of about `limit` bytes."""
    texts = flat(column)
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = SLICE_BYTES) -> np.ndarray:
    """Hash of each byte span. Bytes are summed in windows of `width`, so a long text needs no more room than a short one.

    The width changes the room for the sums and the table of powers, not the hashes.
    """
    power, inverse = _powers(width + 1)
    low, high = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(ends), dtype=np.uint64)
    wanted = [(starts, low, _order(starts)), (ends, high, _order(ends))]
    total, scale = np.uint64(0), 1
    for at in range(0, len(data) + 1, width):
        part = data[at : at + width]
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = total
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        if at:
            sums[1:] *= np.uint64(scale)
            sums[1:] += total
        for places, out, order in wanted:
            a, b = np.searchsorted(places, [at, at + width], sorter=order)
            own = slice(a, b) if order is None else order[a:b]
            out[own] = sums[places[own] - at]
        total, scale = sums[-1], scale * pow(_P, width, 1 << 64) % (1 << 64)
    back = np.array([pow(_P, -width * w, 1 << 64) for w in range(len(data) // width + 1)], dtype=np.uint64)
    unshift = inverse[starts % width] * back[starts // width]
    return mix((high - low) * unshift + (ends - starts).astype(np.uint64))


def _order(places: np.ndarray) -> np.ndarray | None:
    return None if len(places) < 2 or (places[1:] >= places[:-1]).all() else np.argsort(places, kind="stable")


@dataclass
class Words:
    """All words of a slice: hash, byte span, number of their document; `first` has each document's first word, and the end."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.first) - 1


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of one kind other than 0, cut at the texts' borders."""
    if not len(kind):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    change = np.empty(len(kind) + 1, dtype=bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offsets] = True
    at = np.flatnonzero(change)
    inside = kind[at[:-1]] != 0
    return at[:-1][inside], at[1:][inside]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, width: int = SLICE_BYTES) -> Words:
    starts, ends = runs((~_SPACE[data]).view(np.uint8), offsets)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(span_hashes(_LOWER[data], starts, ends, width), starts, ends, doc, first)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; documents are not looked at. Shorter than `hashes` by k - 1.

    Windows of 1, 2, 4, ... words are put together from the ones before.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, part, size = np.zeros(len(hashes) + 1, dtype=np.uint64), 0, hashes, 1
    while k:
        if k & 1:
            m = len(hashes) - done - size + 1
            out = out[:m] + np.uint64(pow(_P, done, 1 << 64)) * part[done : done + m]
            done += size
        k >>= 1
        if k:
            part = part[:-size] + np.uint64(pow(_P, size, 1 << 64)) * part[size:]
            size *= 2
    return mix(out)


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, documents' first places and the end): the k-word shingles of each document in order.

    A document of fewer words has its whole sequence as one, one without words has none.
    """
    counts = np.diff(found.first)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(first[-1], dtype=np.uint64)
    if k <= len(found.hash):
        every = windows(found.hash, k)
        long = counts >= k
        within = np.arange(len(every))
        keep = np.zeros(len(found.hash), dtype=bool)
        keep[: len(every)] = found.doc[: len(every)] == found.doc[k - 1 :]
        place = np.repeat(long, sizes)
        out[place] = every[within[keep[: len(every)]]]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        words_ = found.hash[found.first[d] : found.first[d + 1]]
        out[first[d]] = mix(windows(words_, len(words_)) + np.uint64(len(words_)))[0]
    return out, first


def distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's hashes sorted, without copies, and their new first places."""
    ordered = hashes.copy()
    for a, b in zip(first[:-1], first[1:], strict=True):
        ordered[a:b].sort()
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[first[:-1][first[:-1] < len(ordered)]] = True
    total = np.concatenate([[0], np.cumsum(new)])
    return ordered[new], total[first]


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each document's values; 0 for documents without any."""
    if values.dtype.kind == "u":
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        return total[first[1:]] - total[first[:-1]]
    out = np.zeros(len(first) - 1, dtype=np.float64)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out


def segment_minima(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Smallest value of each document; the largest integer for documents without any."""
    out = np.full(len(first) - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.minimum.reduceat(values, first[:-1][full])
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers as Spark's BIGINT."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)
