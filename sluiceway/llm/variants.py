"""Spelling variants by blocked Gram matrices of letter counts.

Words that differ by one inserted, deleted or replaced letter have letter-count vectors at a squared
distance of at most 2. Words are dealt into blocks of two adjacent lengths; inside a block NumPy's matrix
product of the counts gives all squared distances at once, pairs at 2 or less whose lengths differ by at most
one are kept, and the edit itself is verified letter by letter.

All words of two lengths would be a block that grows with the corpus, so length blocks are divided further,
without losing a pair: of three parts of a word one edit leaves two as they are, so a word goes to the
blocks of its three pairs of parts. A block of more than `BLOCK_WORDS` words is cut into pieces whose pairs
are separate units, so that no unit and no task grows with it. A pair is reported by the first pair of parts
that its words share, thus once.

Word counts: tasks find and count the words of a slice in arrays (a word is known by a 64-bit hash there),
Spark sums them. Null texts have no words; a null doc_id counts as the empty text in the hash that decides
on a deletion; repeated rows count each time. Equal n: the form is the smaller word in code-point order. An
empty table gives no rows. Other columns than doc_id and text are not read, whatever their names. Texts and
words of any length are taken whole; a task holds one slice of whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm import textscan
from sluiceway.session import to_scratch_table

SHORTEST = 7
LEAST = 2
TIMES = 10
MODULUS = 31
SLICE_BYTES = 4 << 20
BLOCK_WORDS = 4096
TILE = 256
# Words of more bytes are hashed and verified one by one.
LONG = 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_COLUMN = np.arange(256) % 6 + 26  # accented letters share six columns: distances can only become smaller
_COLUMN[97:123] = np.arange(26)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_after(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span appended to what `state` is the CRC-32 of."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    long = int((size > LONG).sum())
    out = state.astype(np.uint32).copy()
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]], int(out[i]))
    order = order[long:]
    s, at, size = ~out[order], starts[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1 if len(size) else 1), side="right")
    for k, m in enumerate(active.tolist()):
        s[:m] = _CRC[(s[:m] ^ data[at[:m] + k]) & np.uint32(255)] ^ (s[:m] >> np.uint32(8))
    out[order] = ~s
    return out


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans in a row, and the spans' first places and the end."""
    n = ends - starts
    first = np.concatenate([[0], np.cumsum(n)])
    return data[np.repeat(starts - first[:-1], n) + np.arange(first[-1])], first


def strings(data: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(first.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())


def slice_words(data: np.ndarray, offsets: np.ndarray, doc_ids: list, shortest: int, modulus: int) -> tuple[pa.Array, np.ndarray]:
    """(distinct words, their counts) of a slice, after lower-casing and the deletions."""
    lead = data == 0xC3
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    starts, ends = textscan.runs(letter.view(np.uint8), offsets)
    two_bytes = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    length = (ends - starts) - (two_bytes[ends] - two_bytes[starts])
    keep = length >= shortest
    starts, ends, length = starts[keep], ends[keep], length[keep]
    data = textscan.lowered(data)
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in doc_ids], dtype=np.uint32)
    hashed = crc_after(before[np.searchsorted(offsets, starts, side="right") - 1], data, starts, ends).astype(np.int64)
    cut = hashed % modulus == 0
    place = (hashed % np.maximum(length, 1))[cut & (length > shortest)]
    char_at = np.flatnonzero((data & 0xC0) != 0x80)
    s, e = starts[cut & (length > shortest)], ends[cut & (length > shortest)]
    gone = char_at[np.searchsorted(char_at, s) + place]
    rest, first = gathered(data, np.column_stack([s, gone + 1 + lead[gone]]).ravel()[: 2 * len(s)], np.column_stack([gone, e]).ravel()[: 2 * len(s)])
    first = first[::2]
    starts, ends = starts[~cut], ends[~cut]
    both = np.concatenate([textscan.span_hashes(data, starts, ends), textscan.span_hashes(rest, first[:-1], first[1:])])
    _, some, n = np.unique(both, return_index=True, return_counts=True)
    plain, other = some < len(starts), some[some >= len(starts)] - len(starts)
    a, fa = gathered(data, starts[some[plain]], ends[some[plain]])
    b, fb = gathered(rest, first[:-1][other], first[1:][other])
    words = strings(np.concatenate([a, b]), np.concatenate([fa, fb[1:] + fa[-1]]))
    return words, np.concatenate([n[plain], n[~plain]])


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, modulus: int = MODULUS) -> DataFrame:
    """(word, n) of all words with at least `shortest` letters and `least` occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for at, data, offsets in textscan.slices(batch["text"], SLICE_BYTES):
                words, n = slice_words(data, offsets, ids[at : at + len(offsets) - 1], shortest, modulus)
                yield pa.record_batch([words, pa.array(n.astype(np.int64))], ["word", "n"])

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def parts(base: Column) -> tuple[Column, Column, Column]:
    """Sizes of a word's three parts, by the length of the shorter word of a pair."""
    one = F.floor(base / 3).cast("int")
    two = F.floor((base - one) / 2).cast("int")
    return one, two, base - one - two


def in_blocks(words: DataFrame, shortest: int, block_words: int) -> DataFrame:
    """(key, low, high, piece, less, side, word, n): each word once for each unit that it is compared in.

    `less` is 1 where the word is the longer one of the block's two lengths.
    """
    entries = []
    word = F.col("word")
    for less in (0, 1):
        base = F.length("word") - less
        one, two, three = parts(base)
        for side, (left, right) in enumerate([(one + two, F.lit(0)), (F.lit(0), two + three), (one, three)]):
            key = F.xxhash64(base, F.lit(side), F.left(word, left), F.right(word, right))
            entries.append(F.when(base >= shortest, F.struct(key.alias("key"), F.lit(less).alias("less"), F.lit(side).alias("side"))))
    keyed = words.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("e"), "word", "n").select("e.*", "word", "n")
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block_words)
    large = to_scratch_table(large.select("key", F.ceil(F.col("size") / block_words).cast("int").alias("pieces")), "large_blocks")
    dealt = keyed.join(large, "key", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("word", F.lit("piece")), F.col("pieces")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return dealt.select("key", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece", "less", "side", "word", "n")


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all words' letters in a row as Latin-1 bytes, first places and the end)."""
    column = pa.concat_arrays([column.cast(pa.large_string())])
    _, where, raw = column.buffers()
    first = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, dtype=np.uint8)[first[0] : first[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    first = first - first[0]
    lead = data == 0xC3
    out = data.copy()
    out[1:][lead[:-1]] += 0x40
    two_bytes = np.concatenate([[0], np.cumsum(lead)])
    return out[~lead], first - two_bytes[first]


def letter_counts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Counts of each word's letters, 32 columns."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.bincount(row * 32 + _COLUMN[data], minlength=32 * (len(first) - 1)).reshape(-1, 32).astype(np.float32)


def close_pairs(counts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of words at a squared distance of at most 2 whose lengths differ by at most one."""
    square = (counts * counts).sum(axis=1)
    found = []
    for a in range(0, len(counts), TILE):
        for b in range(a, len(counts), TILE):
            gram = counts[a : a + TILE] @ counts[b : b + TILE].T
            near = square[a : a + TILE, None] + square[None, b : b + TILE] - 2 * gram <= 2
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            keep = (i < j) & (np.abs(length[i] - length[j]) <= 1)
            found.append((i[keep], j[keep]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def shared_ends(data: np.ndarray, first: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix, common suffix) of each pair of words."""
    length = np.diff(first)
    shorter = np.minimum(length[i], length[j])
    prefix, suffix = shorter.copy(), shorter.copy()
    plain = shorter <= LONG
    for out, step, border in ((prefix, 1, first[:-1]), (suffix, -1, first[1:] - 1)):
        waiting = np.flatnonzero(plain)
        for k in range(LONG):
            waiting = waiting[shorter[waiting] > k]
            if not len(waiting):
                break
            equal = data[border[i[waiting]] + step * k] == data[border[j[waiting]] + step * k]
            out[waiting[~equal]] = k
            waiting = waiting[equal]
    for p in np.flatnonzero(~plain).tolist():
        a, b = (data[first[x] : first[x + 1]].tobytes() for x in (i[p], j[p]))
        prefix[p], suffix[p] = _shared(a, b), _shared(a[::-1], b[::-1])
    return prefix, suffix


def near_words(words: DataFrame, shortest: int = SHORTEST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, in both directions, each once."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        """All pairs of a run of whole units."""
        key, low, high, piece, less, side = (table[c].to_numpy() for c in ("key", "low", "high", "piece", "less", "side"))
        data, first = letters(table["word"].combine_chunks())
        length = np.diff(first)
        counts = letter_counts(data, first)
        change = np.append(True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
        unit = np.cumsum(change) - 1
        borders = np.append(np.flatnonzero(change), len(key))
        left, right, at = [], [], 0
        while at < len(borders) - 1:  # small units share a product
            to = max(at + 1, int(np.searchsorted(borders, borders[at] + TILE, side="right")) - 1)
            a, b = int(borders[at]), int(borders[to])
            i, j = close_pairs(counts[a:b], length[a:b])
            left.append(i + a)
            right.append(j + a)
            at = to
        i, j = np.concatenate(left), np.concatenate(right)
        keep = (unit[i] == unit[j]) & ((low[i] == high[i]) | (piece[i] != piece[j])) & (less[i] * less[j] == 0)
        i, j = i[keep], j[keep]
        prefix, suffix = shared_ends(data, first, i, j)
        base = np.minimum(length[i], length[j])
        apart = length[i] != length[j]
        one = base // 3
        two = (base - one) // 2
        shares = [prefix >= one + two, suffix >= base - one, (prefix >= one) & (suffix >= base - one - two)]
        earliest = np.select(shares, [0, 1, 2], 3)
        near = np.where(apart, prefix + suffix >= base, prefix + suffix == base - 1) & (earliest == side[i])
        i, j = i[near], j[near]
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        word, n = table["word"].combine_chunks(), table["n"].combine_chunks()
        return pa.record_batch([word.take(pa.array(a)), word.take(pa.array(b)), n.take(pa.array(b))], ["word", "near", "near_n"])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = [table[c][-1].as_py() for c in ("key", "low", "high")]
            whole = np.zeros(len(table), dtype=bool)
            for c, v in zip(("key", "low", "high"), last, strict=True):
                whole |= table[c].to_numpy() != v
            n = int(whole.sum())  # rows are sorted: the last unit may go on
            if n:
                yield compared(table.slice(0, n))
                held = table.slice(n).combine_chunks().to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    dealt = in_blocks(words, shortest, block_words).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(paired, "word string, near string, near_n long")


def variants(
    docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, times: int = TIMES, modulus: int = MODULUS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    Along a chain of forms n grows by `times` at each step, so its longest length is known from the largest n,
    and the roots are found in rounds that double the step.
    """
    words = to_scratch_table(word_counts(docs, shortest, least, modulus), "words")
    best = near_words(words, shortest, block_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    is_form = -F.col("best.m") >= F.col("n") * times
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    formed = to_scratch_table(formed, "forms")
    largest = formed.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.floor(math.log(max(1, largest / least), times) + 1e-9))
    steps = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest))):
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
