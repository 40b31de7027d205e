"""Packing of token streams into sequences by order-preserving dynamic programming.

Documents are range-partitioned by id and tokenised; each partition's token stream is cut into windows of
at most `length` tokens. A cut costs nothing at a document's end, a little after a sentence and more
elsewhere; padding costs one per token. With g(i) = cost up to cut i + position of i, the best window
ending at j starts at the smallest g among the cuts at most `length` before it; a monotone queue gives that
in constant time per cut. The stream is settled every `block_tokens` at a document's end, so memory is
bounded whatever a partition holds; a block's last window is split into powers of two (which need no
padding) where that is cheaper than padding it.

Ids are those of the given vocabulary. Texts are cut before spaces where the vocabulary's word pattern
always cuts, and around the strings of `added` tokens, which have ids of their own (as `tokenizers` has it
for a vocabulary file as loaded). Each distinct unit is encoded once per task (found by a 64-bit hash of its
bytes), and ids are gathered for all units at once.

Null texts are empty: their document is id 0 alone. Rows with equal ids are separate documents. Rows
without id come first. An empty table gives no pieces. Other columns than doc_id and text are not read,
whatever their names. Texts are taken whole: a task holds one slice of whole texts and a block of tokens.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm import textscan

LENGTH = 1024
PARTITION_BYTES = 64 << 20
BLOCK_TOKENS = 1 << 20
# Bytes of whole texts that are encoded at once.
SLICE_BYTES = 1 << 19
# Most units that a task remembers; the store is emptied beyond it.
UNITS = 500_000
# Cuts inside sentences are looked at every so many tokens.
STEP = 64


@dataclass(frozen=True)
class Penalties:
    """Cost of a cut after a sentence and inside one, in padding tokens."""

    sentence: int = 4
    inside: int = 24


def added_tokens(path: str) -> dict[str, int]:
    """Strings and ids of the added tokens of a vocabulary file in JSON form."""
    with open(path, encoding="utf-8") as file:
        listed = json.load(file).get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in listed):
        raise ValueError("added tokens that take white space or word borders are not supported")
    return {t["content"]: t["id"] for t in listed}


class UnitEncoder:
    """Token ids of whole texts by a byte-level vocabulary in rank form, and the strings of added tokens."""

    def __init__(self, path: str, added: dict[str, int] | None = None) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.model = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = {text.encode(): i for text, i in (added or {}).items()}
        longest_first = sorted(self.added, key=lambda x: (-len(x), x))
        self.find_added = re.compile(b"|".join(map(re.escape, longest_first))) if self.added else None
        ends = np.zeros(max([*ranks.values(), *self.added.values()]) + 1, dtype=bool)
        ends[[i for token, i in ranks.items() if token.endswith((b".", b"!", b"?", b"\n", b"\xe3\x80\x82"))]] = True
        self.ends_sentence = ends
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros(0, dtype=np.int64)
        self.first = np.zeros(1, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint16)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places where units begin: the texts' starts, and spaces before which the pattern surely cuts."""
        at = np.flatnonzero(data == 32)
        at = at[(at > 0) & (at + 1 < len(data))]
        before, after = data[at - 1], data[at + 1]
        plain = (after < 128) & (after > 32)
        # Some white space beyond ASCII begins with these bytes; before it only a visible character makes the cut sure.
        wide = (after >= 128) & (((before > 32) & (before < 127)) | ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3]))
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[at[plain | wide]] = True
        # White space right before an added token belongs together: the text is cut there, not before the last space.
        borders = [x.span() for x in self.find_added.finditer(data.tobytes())] if self.find_added else []
        borders = [(a, b) for a, b in borders if np.searchsorted(offsets, a, side="right") == np.searchsorted(offsets, b - 1, side="right")]
        for a, b in borders:
            begins[a + 1 : b] = False
            if a and data[a - 1] == 32:
                begins[a - 1] = False
        for a, b in borders:
            begins[a] = begins[b] = True
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(begins[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        starts = self.units(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint16), np.zeros(len(offsets) - 1, dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        hashes, some, unit = np.unique(textscan.span_hashes(data, starts, ends, SLICE_BYTES), return_index=True, return_inverse=True)
        if len(self.known) > UNITS:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != hashes
        if new.any():
            raw = data.tobytes()
            encode, added = self.model.encode_ordinary, self.added
            fresh = (raw[a:b] for a, b in zip(starts[some[new]].tolist(), ends[some[new]].tolist(), strict=True))
            ids = [[added[unit_]] if unit_ in added else encode(unit_.decode()) for unit_ in fresh]
            fresh = np.arange(len(ids)) + len(self.first) - 1
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            self.first = np.append(self.first, self.first[-1] + np.cumsum(sizes))
            flat = np.fromiter((i for x in ids for i in x), dtype=np.uint16, count=int(sizes.sum()))
            self.pool = np.append(self.pool, flat)
            self.known = np.insert(self.known, at[new], hashes[new])
            self.place = np.insert(self.place, at[new], fresh)
        row = self.place[np.searchsorted(self.known, hashes)][unit]
        begin, sizes = self.first[row], self.first[row + 1] - self.first[row]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(begin - total[:-1], sizes) + np.arange(total[-1])]
        per_text = total[np.searchsorted(starts, offsets[1:])] - total[np.searchsorted(starts, offsets[:-1])]
        return ids, per_text


def best_cuts(at: list[int], cost: list[int], length: int) -> list[int]:
    """Places in `at` of the cuts of least padding plus penalties; `at` rises from 0 in steps of at most `length`.

    The last place is always cut. A window from i to j costs length - (at[j] - at[i]) + cost[j].
    """
    n = len(at)
    g = [0] * n
    back = [0] * n
    queue = [0] * n  # cuts by rising position and rising g
    head, tail = 0, 1
    for j in range(1, n):
        low = at[j] - length
        while at[queue[head]] < low:
            head += 1
        i = queue[head]
        back[j] = i
        v = g[i] + length + cost[j]
        g[j] = v
        while tail > head and g[queue[tail - 1]] >= v:
            tail -= 1
        queue[tail] = j
        tail += 1
    cuts, j = [n - 1], n - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


def window_ends(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, length: int, penalties: Penalties) -> np.ndarray:
    """Borders of the windows over a block of whole documents, from 0 to its size."""
    size = len(ids)
    sentence = np.flatnonzero(ends_sentence[ids]) + 1
    step = max(1, min(STEP, length // 2))
    at = np.union1d(np.union1d(np.arange(0, size, step), sentence), np.append(doc_ends, size))
    cost = np.full(len(at), penalties.inside, dtype=np.int64)
    cost[np.searchsorted(at, sentence)] = penalties.sentence
    cost[np.searchsorted(at, doc_ends)] = 0
    borders = at[best_cuts(at.tolist(), cost.tolist(), length)]
    last = int(borders[-1] - borders[-2]) if len(borders) > 1 else 0
    powers = [1 << b for b in range(last.bit_length() - 1, -1, -1) if last >> b & 1]
    if len(powers) > 1 and penalties.inside * (len(powers) - 1) < length - last:
        borders = np.concatenate([borders[:-1], borders[-2] + np.cumsum(powers)])
    return borders


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = LENGTH,
    penalties: Penalties = Penalties(),  # noqa: B008
    partition_bytes: int = PARTITION_BYTES,
    with_ids: bool = False,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece of a document: its place in the document and in its sequence, and a checksum of its ids.

    `vocabulary` is the path of a rank file that every executor has, `added` the added tokens' strings and ids
    (see `added_tokens`). With `with_ids` the piece's ids are added.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / partition_bytes))
    placed = (
        rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(n, "doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )
    schema = SCHEMA + ", ids array<int>" if with_ids else SCHEMA

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder(vocabulary, added)
        next_id = TaskContext.get().partitionId() << 40
        waiting: list[tuple[list, np.ndarray, np.ndarray]] = []
        held = 0

        def settle() -> pa.RecordBatch:
            nonlocal next_id
            names = [x for docs_, _, _ in waiting for x in docs_]
            ids = np.concatenate([x for _, x, _ in waiting])
            doc_ends = np.cumsum(np.concatenate([x for _, _, x in waiting]))
            borders = window_ends(ids, doc_ends, encoder.ends_sentence, length, penalties)
            starts = np.union1d(borders[:-1], np.concatenate([[0], doc_ends[:-1]]))
            ends = np.append(starts[1:], len(ids))
            doc = np.searchsorted(doc_ends, starts, side="right")
            doc_start = np.concatenate([[0], doc_ends])
            window = np.searchsorted(borders, starts, side="right") - 1
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = [
                pa.array([names[d] for d in doc.tolist()], pa.int64()),
                pa.array(starts - doc_start[doc], pa.int64()),
                pa.array(ends - starts, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(doc_start[doc + 1] - doc_start[doc], pa.int64()),
                pa.array(window + next_id, pa.int64()),
                pa.array(starts - borders[window], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), pa.array(raw.view("<i4"))))
            next_id += len(borders) - 1
            waiting.clear()
            return pa.record_batch(columns, [*_NAMES, *["ids"] * with_ids])

        for batch in batches:
            names = batch["doc_id"].to_pylist()
            for at, data, offsets in textscan.slices(batch["text"], SLICE_BYTES):
                ids, counts = encoder.encode(data, offsets)
                whole = np.zeros(len(ids) + len(counts), dtype=np.uint16)
                ends = np.cumsum(counts + 1)
                keep = np.ones(len(whole), dtype=bool)
                keep[ends - 1] = False
                whole[keep] = ids
                waiting.append((names[at : at + len(counts)], whole, counts + 1))
                held += len(whole)
                if held >= BLOCK_TOKENS:
                    yield settle()
                    held = 0
        if held:
            yield settle()

    return placed.mapInArrow(textscan.freeing(packed), schema)
