"""Alignment of two tokenizers' tokens by merge-path partitioning.

A is a byte-level vocabulary over a space and the text, B a piece vocabulary over the text (it adds the
space itself). Texts are cut into units where both tokenizers surely cut; each distinct unit is encoded and
aligned once per task. The ends of all A tokens and of all B tokens of a slice's new units are two rising
arrays. Diagonals of their merge matrix, placed every `STEP` steps, are searched by bisection, all at once;
they divide the merge into pieces of equal work that need nothing of each other. All pieces advance side by
side, a step at a time, and emit the pairs of tokens that overlap and the places where both tokens end. A
piece's first and last group may be open; the ends before a piece, summed over pieces, give the number of
the group that it begins in, which stitches them.

Counts of id pairs: a block of documents (`BLOCK_BYTES` of text, in the task that read it) writes its
documents with their distinct pairs as numbers in the block's own list, and that list with the number of
documents that hold each pair. Spark sums the lists by pair, takes each A id's highest count, and joins the
totals back to the blocks, where the documents' sums are taken. A block asks once for a pair however often it
holds it, and nothing is broadcast or collected.

Null and empty texts, and texts whose B bytes differ (those with U+2581, which B reads as a space), have no
tokens: zeros and an empty hash. Strings of special tokens in a text are plain text. Repeated rows and equal
ids are documents of their own and count as such. Tied counts are all highest. An empty table gives no rows.
Other columns than doc_id and text are not read, whatever their names. Long texts are taken whole: a block
ends after the text that fills it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sluiceway.llm import textscan
from sluiceway.llm.rank_merge import PieceMerger, UnitStore, code_points, gathered, unit_starts, with_space
from sluiceway.session import to_scratch_table

STEP = 64
BLOCK_BYTES = 16 << 20
# Most units that a task remembers; the store is emptied beyond it.
UNITS = 1_000_000


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d merged entries come from `a`, for each diagonal d; equal entries of `a` go first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = np.zeros(len(diagonals), dtype=bool)
        before[open_] = a[middle[open_]] <= b[(diagonals - 1 - middle)[open_]]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, group) of every pair of overlapping tokens, in order; both arrays rise and end alike."""
    total = len(ends_a) + len(ends_b)
    begin = np.arange(0, total, step)
    i = merge_path(ends_a, ends_b, begin)
    j = begin - i
    stop = np.iinfo(np.int64).max
    a, b = np.concatenate([[0], ends_a, [stop]]), np.concatenate([[0], ends_b, [stop]])  # place k + 1 is token k's end
    shape = (len(begin), step)
    at_a, at_b = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
    overlap, end = np.zeros(shape, dtype=bool), np.zeros(shape, dtype=bool)
    for k in range(step):
        end_a, end_b = a[i + 1], b[j + 1]
        live = (i < len(ends_a)) & (j < len(ends_b))
        at_a[:, k], at_b[:, k] = i, j
        overlap[:, k] = live & (np.maximum(a[i], b[j]) < np.minimum(end_a, end_b))
        end[:, k] = overlap[:, k] & (end_a == end_b)
        from_a = end_a <= end_b
        more = (i < len(ends_a)) | (j < len(ends_b))
        i, j = i + (from_a & more), j + (~from_a & more)
    ends_in = end.sum(axis=1)
    group = (np.cumsum(ends_in) - ends_in)[:, None] + np.cumsum(end, axis=1) - end
    return at_a[overlap], at_b[overlap], group[overlap]


def joined_ids(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, each group's first place and the end) of `a1,a2|b1;` for all groups. `digits`: ids' decimal digits, left-aligned, zeros after."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    number, side = np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(group_a), len(group_b)])
    order = np.argsort(number * 2 + side, kind="stable")
    ids, number, side = np.concatenate([ids_a, ids_b])[order], number[order], side[order]
    last = np.append((number[1:] != number[:-1]) | (side[1:] != side[:-1]), True) if len(ids) else np.zeros(0, dtype=bool)
    rows = digits[ids]
    size = (rows != 0).sum(axis=1)
    rows = np.column_stack([rows, np.zeros(len(rows), dtype=np.uint8)])
    rows[np.arange(len(rows)), size] = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(","))
    total = np.concatenate([[0], np.cumsum(size + 1)])
    return rows[rows != 0], total[np.searchsorted(number, np.arange(n + 1))]


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, places where each value's bytes begin, and the end): seven bits a byte, low bits first, 0x80 where more follow."""
    size = 1 + sum((values >= 1 << bits).astype(np.int64) for bits in range(7, 35, 7))
    first = np.concatenate([[0], np.cumsum(size)])
    k = np.arange(first[-1]) - np.repeat(first[:-1], size)
    more = k + 1 < np.repeat(size, size)
    return ((np.repeat(values, size) >> (7 * k) & 127) | more * 128).astype(np.uint8), first


def unpacked(data: np.ndarray) -> np.ndarray:
    """The values that `packed` wrote."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    begin = np.flatnonzero(np.append(True, data[:-1] < 128))
    k = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * k), begin)


def binaries(values: np.ndarray, border: np.ndarray) -> pa.Array:
    """One binary of packed values for each row; `border`: rows' first values, and the end."""
    data, first = packed(values)
    return pa.Array.from_buffers(pa.binary(), len(border) - 1, [None, pa.py_buffer(first[border].astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def values_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows in a row, rows' first values and the end)."""
    _, where, raw = column.buffers()
    where = np.frombuffer(where, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8)[where[0] : where[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    return unpacked(data), np.concatenate([[0], np.cumsum(data < 128)])[where - where[0]]


class UnitAligner:
    """Tokens, groups and overlapping id pairs of units, each distinct unit taken once."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path_a, "rb"))}
        self.a = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = PieceMerger(path_b)
        self.size_a = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.size_a[i] = len(token)
        self.size_b = np.ones(max([*self.b.pieces.values(), *self.b.bytes.values()]) + 1, dtype=np.int64)
        for piece, i in self.b.pieces.items():
            self.size_b[i] = len(piece.replace("▁", " ").encode())
        most = max(len(self.size_a), len(self.size_b))
        width = len(str(most))
        self.digits = np.array([list(str(i).encode().ljust(width, b"\0")) for i in range(most)], dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        self.store = UnitStore()
        self.n_a, self.n_b, self.n_groups = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.pairs, self.first = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.good = np.zeros(0, dtype=bool)
        self.groups: list[bytes] = []

    def units(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places where units begin: the texts' starts, and single spaces before a character after which A surely begins a word."""
        at = unit_starts(data, offsets)
        at = at[at + 1 < len(data)]
        before, after = data[np.maximum(at - 1, 0)], data[at + 1]
        # Some white space beyond ASCII begins with these bytes; before it only a visible character makes the cut sure.
        wide = (after >= 128) & (((before > 32) & (before < 127)) | ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3]))
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[at[((after < 128) & (after > 32)) | wide]] = True
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(begins)

    def learn(self, raw: np.ndarray, first: np.ndarray) -> None:
        """Add new units, in order."""
        n = len(first) - 1
        text = raw.tobytes()
        lists = [self.a.encode_ordinary(text[a:b].decode("utf-8", "replace")) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        n_a = np.fromiter(map(len, lists), dtype=np.int64, count=n)
        ids_a = np.fromiter((i for x in lists for i in x), dtype=np.int64, count=int(n_a.sum()))
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[first]
        sym, first_b = self.b.symbols(code_points(text), chars)
        tokens = self.b.sizes(sym)
        total = np.concatenate([[0], np.cumsum(tokens)])
        ids_b, n_b = self.b.expanded(sym), total[first_b[1:]] - total[first_b[:-1]]
        unit_a, unit_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        size = np.diff(first)
        good = (np.bincount(unit_a, self.size_a[ids_a], n) == size) & (np.bincount(unit_b, self.size_b[ids_b], n) == size)
        ids_a, unit_a, ids_b, unit_b = ids_a[good[unit_a]], unit_a[good[unit_a]], ids_b[good[unit_b]], unit_b[good[unit_b]]
        at_a, at_b, group = overlaps(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]))
        group_a, group_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        group_a[at_a], group_b[at_b] = group, group
        groups = int(group[-1]) + 1 if len(group) else 0
        unit_of_group = np.zeros(groups, dtype=np.int64)
        unit_of_group[group_a] = unit_a
        bytes_, group_at = joined_ids(ids_a, ids_b, group_a, group_b, self.digits)
        borders = group_at[np.searchsorted(unit_of_group, np.arange(n + 1))].tolist()
        out = bytes_.tobytes()
        self.groups += [out[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]
        self.n_a = np.append(self.n_a, np.bincount(unit_a, minlength=n))
        self.n_b = np.append(self.n_b, np.bincount(unit_b, minlength=n))
        self.n_groups = np.append(self.n_groups, np.bincount(unit_of_group, minlength=n))
        self.good = np.append(self.good, good)
        self.pairs = np.append(self.pairs, ids_a[at_a] << 32 | ids_b[at_b])
        links = np.bincount(unit_a[at_a], minlength=n)
        self.first = np.append(self.first, self.first[-1] + np.cumsum(links))

    def align(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray | list]:
        """Per text n_a, n_b, n_groups, n_links, groups_sha256; and each text's distinct pairs with how often it holds them."""
        texts = len(offsets) - 1
        data, offsets = with_space(data, offsets)
        starts = self.units(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes, some, unit = np.unique(textscan.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.groups) > UNITS:
            self.forget()
        number, new = self.store.numbers(hashes)
        if new.any():
            self.learn(*gathered(data, starts[some[new]], ends[some[new]]))
        unit = number[unit] if len(number) else unit.astype(np.int64)
        first = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(texts), np.diff(first))
        bad = np.zeros(texts, dtype=bool)
        bad[text[~self.good[unit]]] = True
        keep = ~bad[text]
        unit, text = unit[keep], text[keep]
        out = {c: np.bincount(text, of[unit], texts).astype(np.int64) for c, of in (("n_a", self.n_a), ("n_b", self.n_b), ("n_groups", self.n_groups))}
        first = np.searchsorted(text, np.arange(texts + 1)).tolist()
        of, get = unit.tolist(), self.groups.__getitem__
        out["groups_sha256"] = [hashlib.sha256(b"".join(map(get, of[a:b]))[:-1]).hexdigest() if b > a else "" for a, b in zip(first[:-1], first[1:], strict=True)]
        pairs, at = gathered(self.pairs, self.first[unit], self.first[unit + 1])
        links = np.diff(at)
        out["n_links"] = np.bincount(text, links, texts).astype(np.int64)
        held = np.repeat(text, links)
        order = np.lexsort((pairs, held))
        pairs, held = pairs[order], held[order]
        change = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (held[1:] != held[:-1]))) if len(pairs) else np.zeros(0, dtype=np.int64)
        out["times"] = np.diff(np.append(change, len(pairs))).astype(np.int32)
        out["pairs"], out["holder"] = pairs[change], held[change].astype(np.int32)
        return out


_WRITTEN = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, a int, b int, n long"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_PLAIN = ("n_a", "n_b", "n_groups", "n_links")


def block_batches(block: int, names: list, slices: list[dict]) -> Iterator[pa.RecordBatch]:
    """A block's documents with their packed pairs, then the block's list of pairs."""
    kinds = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
    schema = pa.schema(list(zip([x.split()[0] for x in _WRITTEN.split(", ")], kinds, strict=True)))
    listed, holders = np.unique(np.concatenate([s["pairs"] for s in slices]), return_counts=True)
    at = 0
    for s in slices:
        n = len(s["n_a"])
        place = np.searchsorted(listed, s["pairs"])
        fresh = np.append(True, s["holder"][1:] != s["holder"][:-1]) if len(place) else np.zeros(0, dtype=bool)
        step = np.where(fresh, place, np.diff(place, prepend=0))
        often = s["times"] > 1
        steps = binaries(step * 2 + often, np.searchsorted(s["holder"], np.arange(n + 1)))
        times = binaries(s["times"][often].astype(np.int64), np.searchsorted(s["holder"][often], np.arange(n + 1)))
        columns = [pa.array(np.full(n, block)), pa.array(names[at : at + n], pa.int64()), *(pa.array(s[c]) for c in _PLAIN), pa.array(s["groups_sha256"], pa.string()), steps, times]
        yield pa.record_batch([*columns, *(pa.nulls(n, f.type) for f in list(schema)[9:])], schema=schema)
        at += n
    for p in range(0, len(listed), 1 << 16):
        some = listed[p : p + (1 << 16)]
        filled = [pa.array((some >> 32).astype(np.int32)), pa.array((some & 0xFFFFFFFF).astype(np.int32)), pa.array(holders[p : p + (1 << 16)].astype(np.int64))]
        yield pa.record_batch([pa.array(np.full(len(some), block)), *(pa.nulls(len(some), f.type) for f in list(schema)[1:9]), *filled], schema=schema)


def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its tokens, groups and links, and its links against the corpus-wide counts of their id pairs.

    `path_a` is a rank file of the byte-level vocabulary, `path_b` a piece model; every executor has both.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = UnitAligner(path_a, path_b)
        block, size = TaskContext.get().partitionId() << 32, 0
        names: list = []
        slices: list[dict] = []
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for at, data, offsets in textscan.slices(batch["text"]):
                slices.append(aligner.align(data, offsets))
                names += ids[at : at + len(offsets) - 1]
                size += len(data)
                if size >= block_bytes:
                    yield from block_batches(block, names, slices)
                    block, size, names, slices = block + 1, 0, [], []
        if slices:
            yield from block_batches(block, names, slices)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(written, _WRITTEN)
    rows = to_scratch_table(rows, "aligned")
    listed = rows.where(F.col("a").isNotNull()).select("block", "a", "b", "n")
    totals = listed.groupBy("a", "b").agg(F.sum("n").alias("count"))
    totals = totals.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))
    answers = listed.select(F.col("block").alias("asker"), "a", "b").join(totals, ["a", "b"]).select("asker", "a", "b", "count", "best")

    def summed(own: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told["a"].to_numpy().astype(np.int64) << 32 | told["b"].to_numpy())
        count = told["count"].to_numpy().astype(np.int64)[order]
        best = told["best"].to_numpy(zero_copy_only=False).astype(np.int64)[order]
        n_best, count_sum = [], []
        for chunk in own.select(["pairs", "times"]).to_batches():
            step, border = values_of(chunk["pairs"])
            holder = np.repeat(np.arange(len(chunk)), np.diff(border))
            times = np.ones(len(step), dtype=np.int64)
            times[step & 1 == 1] = values_of(chunk["times"])[0]
            step >>= 1
            total = np.cumsum(step)
            base = np.concatenate([[0], total])[border[:-1]]
            place = total - np.repeat(base, np.diff(border))
            n_best.append(np.bincount(holder, best[place] * times, len(chunk)).astype(np.int64))
            sums = np.concatenate([[0], np.cumsum(count[place] * times)])
            count_sum.append(np.diff(sums[border]))
        found = own.select(["doc_id", *_PLAIN])
        for name, parts in (("n_best", n_best), ("count_sum", count_sum)):
            found = found.append_column(name, pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *parts])))
        return found.append_column("groups_sha256", own["groups_sha256"])

    own = rows.where(F.col("a").isNull()).select("block", "doc_id", *_PLAIN, "groups_sha256", "pairs", "times")
    return own.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(summed, _RESULT)

