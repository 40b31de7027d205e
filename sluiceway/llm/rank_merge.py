"""Token counts by rank-synchronous array merging.

Texts are cut before spaces that follow another character: no piece of the vocabulary reaches over such a
place. Each distinct unit is merged once per task (found by a 64-bit hash of its bytes). All new units of a
slice are held as one ragged array of symbols, cut further where no piece holds the two characters side by
side. In one round every sequence merges its pair of lowest rank (of equal ranks the leftmost); pairs beside
a merge are looked up again, and sequences without a pair left leave the array. A symbol that survives is
one token, a character outside the vocabulary one per UTF-8 byte.

A sequence of more than `LONG` symbols (no space, every neighbour possible) would need as many rounds as it
has merges, each over its whole length; it is merged alone through a priority queue in the same order.

Made for BPE models with byte fallback whose normaliser only adds a space before the text and writes spaces
as U+2581; the loader compares a few strings with the library and raises where they differ. Control pieces
(`<s>`) in a text are plain text, as the library has it.

Null and empty texts have 0 tokens. Repeated rows and equal ids are separate rows. An empty table gives no
rows. Other columns than doc_id and text are not read, whatever their names. A text may be as long as
Spark's strings; units are bounded by the text, and a task holds one slice of whole texts at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm import textscan

LONG = 256
LIMIT = 4096
# Most units that a task remembers; the store is emptied beyond it.
UNITS = 1_500_000
_NONE = np.int32(2**31 - 1)
# Characters outside the vocabulary are symbols from here on, by code point.
OUTSIDE = 1 << 24
_BAR = 0x2581
_PROBES = ["a", " the  end ", "un\n\tdeux <s> </s> <0x41> é ▁ 漢字 \U0001f600", "   aaaaaaa", "x▁ y"]


class PairTable:
    """Open-addressed table from pairs of symbols to their number."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.bits = max(10, int(len(keys) * 16).bit_length())
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.slot = np.full(1 << self.bits, len(keys), dtype=np.int32)
        waiting, at = np.arange(len(keys)), self._home(keys)
        while len(waiting):
            free = self.slot[at] == len(keys)
            self.slot[at[free]] = waiting[free]
            lost = self.slot[at] != waiting
            waiting, at = waiting[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair; the number of pairs for those not in the table."""
        none = len(self.keys) - 1
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._home(keys)
        out = self.slot[at]
        wrong = np.flatnonzero((self.keys[out] != keys) & (out != none))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            out[wrong] = self.slot[at[wrong]]
            wrong = wrong[(self.keys[out[wrong]] != keys[wrong]) & (out[wrong] != none)]
        return out


class PieceMerger:
    """Symbols of units by a vocabulary of pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = (model.is_control, model.is_unknown, model.is_byte)
        self.pieces = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)}
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(model.get_piece_size()) if model.is_byte(i)}
        symbols = dict(self.pieces)
        for char in {c for piece in self.pieces for c in piece} - set(symbols):
            symbols[char] = OUTSIDE + ord(char)
        levels = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in self.pieces.values()}, reverse=True))}
        made = [
            (symbols[piece[:k]], symbols[piece[k:]], levels[model.get_score(i)], i)
            for piece, i in self.pieces.items()
            for k in range(1, len(piece))
            if piece[:k] in symbols and piece[k:] in symbols
        ]
        left, right, rank, into = (np.array(x, dtype=np.int64) for x in (zip(*made, strict=True) if made else ((), (), (), ())))
        self.table = PairTable(left, right)
        self.rank = np.append(rank, _NONE).astype(np.int32)
        self.into = np.append(into, 0).astype(np.int64)
        beside = np.array(sorted({(ord(a), ord(b)) for piece in self.pieces for a, b in zip(piece, piece[1:])}), dtype=np.int64).reshape(-1, 2)
        self.beside = PairTable(beside[:, 0], beside[:, 1])
        self.of_char = np.arange(0x110000, dtype=np.int64) + OUTSIDE
        for piece, i in self.pieces.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        if any(a != "▁" == b for piece in self.pieces for a, b in zip(piece, piece[1:])):
            raise ValueError("pieces that hold a space after another character: units can't be cut at spaces")
        for text in _PROBES:
            if self.ids(np.array([ord(c) for c in " " + text], dtype=np.uint32)).tolist() != model.encode(text):
                raise ValueError("not a BPE model with byte fallback and without a normaliser")

    def symbols(self, chars: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(surviving symbols of all units in a row, the units' first places and the end). `chars`: code points, spaces as such."""
        units = len(first) - 1
        chars = np.where(chars == 32, _BAR, chars).astype(np.int64)
        sym = self.of_char[chars]
        unit = np.repeat(np.arange(units), np.diff(first))
        if not len(chars):
            return sym, first
        starts = np.ones(len(chars), dtype=bool)
        starts[1:] = (unit[1:] != unit[:-1]) | (self.beside.find(chars[:-1], chars[1:]) == len(self.beside.keys) - 1)
        seq = np.cumsum(starts) - 1
        border = np.append(np.flatnonzero(starts), len(chars))
        done_place, done_sym, done_unit = [], [], []
        size = np.diff(border)
        for s in np.flatnonzero(size > LONG).tolist():
            a, b = int(border[s]), int(border[s + 1])
            left = np.array(self._one_by_one(sym[a:b].tolist()), dtype=np.int64)
            done_place.append(np.full(len(left), a))
            done_sym.append(left)
            done_unit.append(np.full(len(left), unit[a]))
        keep = (size <= LONG)[seq]
        place = border[seq][keep]  # a sequence goes by the place of its first character
        sym, unit, seq = sym[keep], unit[keep], seq[keep]
        pair = np.full(len(sym), len(self.table.keys) - 1, dtype=np.int32)
        inner = np.flatnonzero(seq[1:] == seq[:-1]) if len(seq) else seq
        pair[inner] = self.table.find(sym[inner], sym[inner + 1])
        while len(sym):
            rank = self.rank[pair]
            begin = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            n = np.diff(np.append(begin, len(seq)))
            least = np.minimum.reduceat(rank, begin)
            over = np.repeat(least == _NONE, n)
            if over.any():
                done_place.append(place[over])
                done_sym.append(sym[over])
                done_unit.append(unit[over])
                go = ~over
                sym, unit, seq, place, pair, rank = sym[go], unit[go], seq[go], place[go], pair[go], rank[go]
                if not len(sym):
                    break
                least, n = least[least != _NONE], n[least != _NONE]
            hit = np.flatnonzero(rank == np.repeat(least, n))
            at = hit[np.append(True, seq[hit[1:]] != seq[hit[:-1]])]
            sym[at] = self.into[pair[at]]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            sym, unit, seq, place, pair = sym[stay], unit[stay], seq[stay], place[stay], pair[stay]
            at = at - np.arange(len(at))
            beside = np.zeros(len(sym), dtype=bool)
            beside[at] = beside[at[at > 0] - 1] = True
            again = np.flatnonzero(beside)
            last = again + 1 >= len(sym)
            last[~last] = seq[again[~last]] != seq[again[~last] + 1]
            pair[again[last]] = len(self.table.keys) - 1
            again = again[~last]
            pair[again] = self.table.find(sym[again], sym[again + 1])
        order = np.argsort(np.concatenate(done_place), kind="stable")
        sym, unit = np.concatenate(done_sym)[order], np.concatenate(done_unit)[order]
        return sym, np.searchsorted(unit, np.arange(units + 1))

    def _one_by_one(self, sym: list[int]) -> list[int]:
        """Surviving symbols of one long sequence: always the pair of lowest rank, of equal ranks the leftmost."""
        right = list(range(1, len(sym) + 1))
        left = list(range(-1, len(sym) - 1))
        first = self.table.find(np.array(sym[:-1]), np.array(sym[1:]))
        queue = [(int(self.rank[p]), i, sym[i], sym[i + 1], int(self.into[p])) for i, p in enumerate(first.tolist()) if self.rank[p] != _NONE]
        heapq.heapify(queue)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def look(i: int, j: int) -> None:
            key = (sym[i], sym[j])
            if key not in known:
                p = int(self.table.find(np.array([key[0]]), np.array([key[1]]))[0])
                known[key] = (int(self.rank[p]), int(self.into[p]))
            rank, into = known[key]
            if rank != _NONE:
                heapq.heappush(queue, (rank, i, *key, into))

        while queue:
            _, i, a, b, into = heapq.heappop(queue)
            j = right[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = into, -1, right[j]
            if right[j] < len(sym):
                left[right[j]] = i
                look(i, right[j])
            if left[i] >= 0:
                look(left[i], i)
        return [s for s in sym if s >= 0]

    def sizes(self, sym: np.ndarray) -> np.ndarray:
        """Tokens of each symbol: its UTF-8 bytes outside the vocabulary, else one."""
        char = sym - OUTSIDE
        return np.where(sym < OUTSIDE, 1, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000))

    def expanded(self, sym: np.ndarray) -> np.ndarray:
        """Token ids of the symbols: pieces, and bytes for characters outside the vocabulary."""
        n = self.sizes(sym)
        out = np.repeat(sym, n)
        begin = np.cumsum(n) - n
        for i in np.flatnonzero(sym >= OUTSIDE).tolist():
            raw = chr(int(sym[i]) - OUTSIDE).encode()
            out[begin[i] : begin[i] + len(raw)] = [self.bytes[b] for b in raw]
        return out

    def ids(self, chars: np.ndarray) -> np.ndarray:
        return self.expanded(self.symbols(chars, np.array([0, len(chars)]))[0])


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a space before every text that isn't empty, and the new offsets."""
    full = np.diff(offsets) > 0
    out = np.insert(data, offsets[:-1][full], np.uint8(32))
    return out, offsets + np.concatenate([[0], np.cumsum(full)])


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where units begin: the texts' starts, and spaces after any character but a space or U+2581."""
    at = np.flatnonzero(data == 32)
    inner = at[at > 2]
    bar = (data[inner - 1] == 0x81) & (data[inner - 2] == 0x96) & (data[inner - 3] == 0xE2)
    early = at[(at > 0) & (at <= 2)]
    inner = np.concatenate([early, inner[~bar]])
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[inner[data[inner - 1] != 32]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def code_points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans in a row, and the spans' first places and the end."""
    n = ends - starts
    first = np.concatenate([[0], np.cumsum(n)])
    return data[np.repeat(starts - first[:-1], n) + np.arange(first[-1])], first


class UnitStore:
    """Numbers of units by their hash, in the order in which they were first met."""

    def __init__(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.number = np.zeros(0, dtype=np.int64)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each of the sorted distinct hashes, which of them are new)."""
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != hashes
        if new.any():
            fresh = len(self.known) + np.arange(int(new.sum()))
            self.known = np.insert(self.known, at[new], hashes[new])
            self.number = np.insert(self.number, at[new], fresh)
        return self.number[np.searchsorted(self.known, hashes)], new


class UnitCounter:
    """Tokens of whole texts, each distinct unit counted once."""

    def __init__(self, path: str) -> None:
        self.merger = PieceMerger(path)
        self._forget()

    def _forget(self) -> None:
        self.store, self.tokens = UnitStore(), np.zeros(0, dtype=np.int64)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        data, offsets = with_space(data, offsets)
        starts = unit_starts(data, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        hashes, some, unit = np.unique(textscan.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.tokens) > UNITS:
            self._forget()
        number, new = self.store.numbers(hashes)
        if new.any():
            raw, first = gathered(data, starts[some[new]], ends[some[new]])
            chars = code_points(raw.tobytes())
            char_at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[first]
            sym, first = self.merger.symbols(chars, char_at)
            total = np.concatenate([[0], np.cumsum(self.merger.sizes(sym))])
            self.tokens = np.append(self.tokens, total[first[1:]] - total[first[:-1]])
        total = np.concatenate([[0], np.cumsum(self.tokens[number][unit])])
        return total[np.searchsorted(starts, offsets[1:])] - total[np.searchsorted(starts, offsets[:-1])]


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, without a shuffle.

    `vocabulary` is the path of a piece model that every executor has.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnitCounter(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for _, data, offsets in textscan.slices(batch["text"]):
                n_bytes.append(np.diff(offsets))
                n_tokens.append(counter.count(data, offsets))
            tokens = np.concatenate(n_tokens)
            yield pa.record_batch([batch["doc_id"], pa.array(np.concatenate(n_bytes)), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(counted, SCHEMA)
