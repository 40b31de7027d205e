"""LM scoring with a weighted backoff automaton of order 3.

The training n-grams become an automaton. Its states are the root, one per word seen in training (with one for the
start of a text) and one per pair of consecutive words; a state has an arc for each word that followed it, and a failure
arc to the state of the history without its first word: from a pair to its second word, from a word to the root. With
counts c, the root's arcs weigh p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); an arc from history h weighs
(c(h w) + mu q(w)) / (c(h) + mu), where q(w) is the weight of w one failure arc further, and the failure arc
mu / (c(h) + mu). Each state's weights sum to one over the V + 1 words.

A text is traversed once from left to right. The state carried to a token is the longest known history; where it has
no arc for the token, failure arcs are followed and weighed until a state has one (the root always has). The arc taken
decides the next state, and log10 weights accumulate. As a state holds two words at most, a block's texts are
traversed together in array steps.

The automaton grows with the corpus, so no task holds it: blocks of documents get the part they walk on
(see `blocks`). Null texts are empty (they have the end token alone); rows with equal ids are separate
documents; an empty table gives an empty result; long texts go in parts of words, columns beside doc_id and text are not
looked at unless `train` does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm import blocks, textscan

# Strength of the failure arc: as many observations as it counts for.
MU = 20.0
_END = np.uint64(0x51AFD7ED558CCD13)
_START = np.uint64(0xC4CEB9FE1A85EC53)
_ORDER = 3
_ASK = "bucket int, block int, kind int, n int, hashes binary, counts binary"
_ANSWER = "block int, bucket int, kind int, n int, counts binary, tokens long, types long"
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _packed(values: np.ndarray) -> bytes:
    """64-bit integers, compressed: bytes of one significance lie together."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)


def _steps(ordered: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes, the first from 0; their leading bytes are mostly 0."""
    return np.diff(ordered, prepend=np.uint64(0))


def _tokens(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a block's texts: (number of the first, tokens with ends, texts' first places and the end)."""
    for at, data, offsets in textscan.slices(table["text"]):
        found = textscan.words(data, offsets)
        first = found.first + np.arange(len(found.first))
        tokens = np.full(first[-1], _END, dtype=np.uint64)
        word = np.ones(first[-1], dtype=bool)
        word[first[1:] - 1] = False
        tokens[word] = found.hash
        yield at, tokens, first


def _carried(values: np.ndarray, first: np.ndarray, at_start) -> np.ndarray:
    """Each place's value from the place before; `at_start` where a text begins."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first[:-1]] = at_start
    return out


def _joined(history: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return textscan.mix(history * np.uint64(0x9FB21C651E98DF25) + tokens)


def _ngrams(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words, pairs and triples that end at each place; a text's first place ends no triple (0 there)."""
    pairs = _joined(_carried(tokens, first, _START), tokens)
    triples = _joined(_carried(pairs, first, 0), tokens)
    triples[first[:-1]] = 0
    return [tokens, pairs, triples]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of all parts and their summed counts; the parts are given up."""
    hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[starts], np.add.reduceat(counts, starts, dtype=np.int64)


def _found(hashes: np.ndarray, counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Counts of n-grams that all are among the hashes; looked up in order, so that memory is read once along."""
    order = np.argsort(grams)
    out = np.empty(len(grams), dtype=np.int64)
    out[order] = counts[np.searchsorted(hashes, grams[order])]
    return out


def _grams(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the block's distinct n-grams, sorted, with their counts in training texts."""
    train = table["train"].to_numpy()
    parts: list[list] = [[] for _ in range(_ORDER)]
    for at, tokens, first in _tokens(table):
        learnt = np.repeat(train[at : at + len(first) - 1], np.diff(first))
        for kept, grams in zip(parts, _ngrams(tokens, first), strict=True):
            order = np.argsort(grams)
            grams = grams[order]
            starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            kept.append((grams[starts], np.add.reduceat(learnt[order], starts, dtype=np.int32)))
    return [_summed(kept) for kept in parts]


def score_texts(docs: DataFrame, train: Column, mu: float = MU, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """Score every text by the model learnt from the rows where `train` holds.

    Returns doc_id, held_out (not trained on), n_tokens, n_known, train_tokens, base_score (root arcs
    alone) and score.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    rows, n = blocks.in_compressed_blocks(rows, block_bytes)

    def question(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        out = []
        for kind, (known, counts) in enumerate(_grams(blocks.unpacked(table)), 1):
            cut = blocks.cuts(known, n)
            for b, (x, y) in enumerate(zip(cut, cut[1:], strict=False)):
                if x < y:
                    out.append((b, block, kind, y - x, _packed(_steps(known[x:y])), _packed(counts[x:y])))
        names = ("bucket", "block", "kind", "n", "hashes", "counts")
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({name: pa.array(column, t) for name, column, t in zip(names, zip(*out, strict=True), types, strict=True)})

    def reply(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        out, tokens, types = [], 0, 0
        for kind in range(1, _ORDER + 1):
            mine = table.filter(pa.compute.equal(table["kind"], kind)).select(["block", "n", "hashes", "counts"]).to_pylist()
            if not mine:
                continue
            hashes = np.concatenate([np.cumsum(_unpacked(r["hashes"], r["n"]), dtype=np.uint64) for r in mine])
            known, at = np.unique(hashes, return_inverse=True)
            totals = np.zeros(len(known), dtype=np.int64)
            np.add.at(totals, at, np.concatenate([_unpacked(r["counts"], r["n"]) for r in mine]).view(np.int64))
            if kind == 1:
                tokens, types = int(totals.sum()), int((totals > 0).sum())
            ends = np.cumsum([r["n"] for r in mine])
            out += [(r["block"], bucket, kind, r["n"], _packed(totals[at[e - r["n"] : e]]), 0, 0) for r, e in zip(mine, ends, strict=True)]
        # Every block needs N and V: each bucket tells every block its share of them.
        out += [(b, bucket, 0, 0, b"", tokens, types) for b in range(n)] if types else []
        names = ("block", "bucket", "kind", "n", "counts", "tokens", "types")
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return pa.table({name: pa.array(column, t) for name, column, t in zip(names, zip(*out, strict=True), kinds, strict=True)})

    def read(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({name: pa.array([], t) for name, t in _RESULT_TYPES})
        table = blocks.unpacked(table)
        got = answers.sort_by("bucket")
        n_train, n_types = int(np.sum(got["tokens"].to_numpy())), int(np.sum(got["types"].to_numpy()))
        root = 0.1 * (n_types + 1) + n_train
        known = []
        for kind, (hashes, _) in enumerate(_grams(table), 1):
            mine = got.filter(pa.compute.equal(got["kind"], kind)).select(["n", "counts"]).to_pylist()
            known.append((hashes, np.concatenate([_unpacked(r["counts"], r["n"]) for r in mine]).view(np.int64)))
        words, word_counts = known[0]
        texts = word_counts[np.searchsorted(words, _END)]
        out = []
        for _, tokens, first in _tokens(table):
            seen = [_found(*of_order, grams) for of_order, grams in zip(known, _ngrams(tokens, first), strict=True)]
            seen[2][first[:-1]] = 0
            # How often training left each history of one and two words; a text begins in the start state, left once per text.
            left = [None, _carried(seen[0], first, texts), _carried(seen[1], first, 0)]
            arcs = [(seen[0] + 0.1) / root]
            for order in (1, 2):
                arcs.append((seen[order] + mu * arcs[-1]) / (left[order] + mu))
            base = np.log10(arcs[0])
            weight, walking = np.zeros(len(tokens)), np.ones(len(tokens), dtype=bool)
            # The state carried to a token has as many words as the longest history that training left.
            state = np.where(left[2] > 0, 2, np.where(left[1] > 0, 1, 0))
            for order in (2, 1):
                here = walking & (state == order)
                taken = here & (seen[order] > 0)
                weight[taken] += np.log10(arcs[order][taken])
                walking &= ~taken
                failing = here & ~taken
                weight[failing] += np.log10(mu / (left[order][failing] + mu))
                state[failing] = order - 1
            weight[walking] += base[walking]
            n_known = textscan.segment_sums((seen[0] > 0).astype(np.float64), first).astype(np.int64)
            out.append((np.diff(first), n_known, textscan.segment_sums(base, first), textscan.segment_sums(weight, first)))
        lengths, known, base, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": pa.array(~table["train"].to_numpy()),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(len(lengths), n_train, dtype=np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    answers = blocks.answer(blocks.ask(rows, question, _ASK), reply, _ANSWER)
    return blocks.finish(rows, answers, read, _RESULT)


_RESULT_TYPES = (
    ("doc_id", pa.int64()),
    ("held_out", pa.bool_()),
    ("n_tokens", pa.int64()),
    ("n_known", pa.int64()),
    ("train_tokens", pa.int64()),
    ("base_score", pa.float64()),
    ("score", pa.float64()),
)
