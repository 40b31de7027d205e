"""Suffix-array dedup on sparse suffixes: passages of at least `length` words that occur in several documents.

Word sequences (A-Z lower-cased) keep only the suffixes that start at minimisers: positions whose GRAM-word
hash is the smallest among `length` - GRAM + 1 neighbouring ones. Every passage of `length` words holds one,
at the same place in all its copies, and about one position in twenty is kept.

First the retained suffixes are sorted by their leading words across all blocks of the corpus; those without
an equal neighbour in another document are dropped. The rest are extended left and right: the fingerprints
of the passages of `length` words whose minimiser it is are sorted with it, and equal neighbours of
different documents are matches. (Comparing a suffix with its next neighbour alone would miss
matches that lie mostly to its left.) Matches that follow each other make one span, so spans are maximal.

Blocks hold bounded text and send each suffix, and each passage, once with its least and greatest document,
however often it occurs, so a passage that all documents share is one entry per block (see `blocks`).

Null texts are empty. Rows with the same doc_id count as one document: what only they share is no match;
rows without id are one document too. A passage repeated inside one document alone is no match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sluiceway.llm import blocks, textscan

LENGTH = 50
GRAM = 12
# Several arrays of the size of a block's words are held at once.
BLOCK_BYTES = 6 << 20
_NULL_ID = np.iinfo(np.int64).min
_ASK = "bucket int, block int, hashes binary, least binary, most binary"
_ANSWER = "block int, bucket int, repeated binary"
_RUNS = "bucket int, suffix binary, least binary, most binary, sizes binary, passages binary, owners binary, starts binary, keys binary, members binary"
_SPANS = "doc_id long, text_key long, start long, end long, first boolean"


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` neighbouring hashes the position of the least one, the rightmost of equals."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    # Least of ever wider runs by doubling.
    best, at, size = grams, np.arange(len(grams)), 1
    while size < width:
        step = min(size, width - size)
        other, other_at = best[step:], at[step:]
        take = other <= best[: len(other)]
        best = np.where(take, other, best[: len(other)])
        at = np.where(take, other_at, at[: len(other_at)])
        size += step
    return at


class _Block:
    """Words, grams and minimisers of a block's texts."""

    def __init__(self, table: pa.Table, length: int) -> None:
        parts, counts = [], []
        for _, data, offsets in textscan.slices(table["text"], textscan.SMALL_SLICE_BYTES):
            found = textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES)
            parts.append(found.hash)
            counts.append(np.diff(found.first))
        self.words = np.concatenate([*parts, np.zeros(0, dtype=np.uint64)])
        self.first = np.concatenate([[0], *[np.cumsum(np.concatenate([*counts, np.zeros(0, dtype=np.int64)]))]]).astype(np.int64)
        gram = min(GRAM, length)
        self.grams = _windows(self.words, gram)
        owner = minimisers(self.grams, length - gram + 1)
        starts = np.arange(len(owner))
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        inside = doc[: len(owner)] == doc[length - 1 :]
        starts, owner = starts[inside], owner[inside]
        # Passages of the same minimiser lie side by side: from `low` to `high`.
        new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else starts
        self.places, self.low, self.doc = owner[new], starts[new], doc[starts[new]]
        self.high = starts[np.append(new[1:], len(owner)) - 1] if len(owner) else starts
        self.ids = table["doc_id"].combine_chunks().fill_null(_NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = table["text_key"].to_numpy().astype(np.int64)


def _windows(words: np.ndarray, k: int, at_once: int = 1 << 20) -> np.ndarray:
    """`textscan.windows` in parts, so its tables of powers stay small."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return np.concatenate([textscan.windows(words[a : min(a + at_once, n) + k - 1], k) for a in range(0, n, at_once)])


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts, starts of runs of equal values in it)."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    return order, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)


def repeated_spans(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text_key, start, end (in words), first: the maximal spans of each document whose every passage of
    `length` words occurs in another document too; `first` where this document holds the least doc_id of all of them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    rows, n = blocks.in_blocks(rows, block_bytes=block_bytes)
    gram = min(GRAM, length)

    def question(table: pa.Table) -> pa.Table:
        own = _Block(table, length)
        suffixes, ids = own.grams[own.places], own.ids[own.doc]
        order, starts = _grouped(suffixes)
        if not len(starts):
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), **{x: pa.array([], pa.binary()) for x in ("hashes", "least", "most")}})
        known = suffixes[order][starts]
        least, most = np.minimum.reduceat(ids[order], starts), np.maximum.reduceat(ids[order], starts)
        cut = blocks.cuts(known, n)
        parts = [(b, known[x:y].tobytes(), least[x:y].tobytes(), most[x:y].tobytes()) for b, (x, y) in enumerate(zip(cut, cut[1:], strict=False)) if x < y]
        bucket, hashes, low, high = zip(*parts, strict=True)
        block = [table["block"][0].as_py()] * len(parts)
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "block": pa.array(block, pa.int32()), "hashes": pa.array(hashes, pa.binary()), "least": pa.array(low, pa.binary()), "most": pa.array(high, pa.binary())})

    def reply(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, dtype=np.uint64) for x in table["hashes"].to_pylist()]
        least = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table["least"].to_pylist()])
        most = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table["most"].to_pylist()])
        order, starts = _grouped(np.concatenate(hashes))
        shared = np.minimum.reduceat(least[order], starts) < np.maximum.reduceat(most[order], starts)
        flags = np.empty(len(order), dtype=bool)
        flags[order] = np.repeat(shared, np.diff(np.append(starts, len(order))))
        ends = np.cumsum([len(h) for h in hashes])
        packed = [np.packbits(flags[e - len(h) : e]).tobytes() for h, e in zip(hashes, ends, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "repeated": pa.array(packed, pa.binary())})

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        empty = pa.table({"bucket": pa.array([], pa.int32()), **{x.split()[0]: pa.array([], pa.binary()) for x in _RUNS.split(", ")[1:]}})
        if not table.num_rows or not answers.num_rows:
            return empty
        own = _Block(table, length)
        known = np.unique(own.grams[own.places])
        cut = blocks.cuts(known, n)
        sizes = {b: int(y - x) for b, (x, y) in enumerate(zip(cut, cut[1:], strict=False))}
        got = answers.sort_by("bucket")
        flags = [np.unpackbits(np.frombuffer(r, dtype=np.uint8), count=sizes[b]) for b, r in zip(got["bucket"].to_pylist(), got["repeated"].to_pylist(), strict=True)]
        repeated = np.concatenate(flags).astype(bool)
        keep = repeated[np.searchsorted(known, own.grams[own.places])]
        places, doc, low, high = own.places[keep], own.doc[keep], own.low[keep], own.high[keep]
        if not len(places):
            return empty
        passages = _windows(own.words, length)
        count = high - low + 1
        total = np.concatenate([[0], np.cumsum(count)])
        flat = passages[np.repeat(low - total[:-1], count) + np.arange(total[-1])]
        # Equal runs (same suffix, same passages around it) go out once, with all their places.
        marks = textscan.mix(np.add.reduceat(textscan.mix(flat + np.arange(len(flat)).astype(np.uint64) - np.repeat(total[:-1], count).astype(np.uint64)), total[:-1]) + own.grams[places])
        order, starts = _grouped(marks)
        run_ids = own.ids[doc]
        chosen = order[starts]
        least, most = np.minimum.reduceat(run_ids[order], starts), np.maximum.reduceat(run_ids[order], starts)
        members = np.diff(np.append(starts, len(order)))
        suffix = own.grams[places[chosen]]
        by_suffix = np.argsort(suffix, kind="stable")
        cut = blocks.cuts(suffix[by_suffix], n)
        out = []
        for b, (x, y) in enumerate(zip(cut, cut[1:], strict=False)):
            if x == y:
                continue
            runs = by_suffix[x:y]
            mine = np.concatenate([order[starts[r] : starts[r] + members[r]] for r in runs])
            out.append(
                (
                    b,
                    suffix[runs].tobytes(),
                    least[runs].tobytes(),
                    most[runs].tobytes(),
                    count[chosen[runs]].astype(np.int32).tobytes(),
                    np.concatenate([flat[total[c] : total[c + 1]] for c in chosen[runs]]).tobytes(),
                    run_ids[mine].tobytes(),
                    (low[mine] - own.first[doc[mine]]).tobytes(),
                    own.keys[doc[mine]].tobytes(),
                    members[runs].astype(np.int32).tobytes(),
                )
            )
        columns = list(zip(*out, strict=True))
        names = [x.split()[0] for x in _RUNS.split(", ")]
        return pa.table({name: pa.array(c, pa.int32() if name == "bucket" else pa.binary()) for name, c in zip(names, columns, strict=True)})

    def compare(table: pa.Table) -> pa.Table:
        def column(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, dtype=kind) for x in table[name].to_pylist()])

        sizes, passages = column("sizes", np.int32), column("passages", np.uint64)
        run = np.repeat(np.arange(len(sizes)), sizes)
        # Passages sorted with their suffix: the suffix's hash is part of what is compared.
        order, starts = _grouped(textscan.mix(passages ^ column("suffix", np.uint64)[run]))
        least, most = column("least", np.int64)[run][order], column("most", np.int64)[run][order]
        low, high = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
        times = np.diff(np.append(starts, len(order)))
        shared, holder = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=np.int64)
        shared[order], holder[order] = np.repeat(low < high, times), np.repeat(low, times)
        # Each occurrence of a run gets its passages' verdicts; stretches of equal verdict become rows.
        members = column("members", np.int32)
        owner, begin, key = column("owners", np.int64), column("starts", np.int64), column("keys", np.int64)
        of = np.repeat(np.arange(len(sizes)), members)
        first_passage = np.concatenate([[0], np.cumsum(sizes)])
        reps = sizes[of].astype(np.int64)
        at = np.repeat(first_passage[of] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
        occurrence = np.repeat(np.arange(len(of)), reps)
        place = begin[occurrence] + at - first_passage[of][occurrence]
        state = np.where(shared[at], np.where(holder[at] == owner[occurrence], 2, 1), 0)
        change = np.concatenate([[True], (occurrence[1:] != occurrence[:-1]) | (state[1:] != state[:-1])])
        opens = np.flatnonzero(change)
        closes = np.append(opens[1:], len(state)) - 1
        found = state[opens] > 0
        opens, closes = opens[found], closes[found]
        ids = owner[occurrence[opens]]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=ids == _NULL_ID),
                "text_key": pa.array(key[occurrence[opens]], pa.int64()),
                "start": pa.array(place[opens], pa.int64()),
                "end": pa.array(place[closes] + length, pa.int64()),
                "first": pa.array(state[opens] == 2),
            }
        )

    answers = blocks.answer(blocks.ask(rows, question, _ASK), reply, _ANSWER)
    runs = blocks.finish(rows, answers, extend, _RUNS)
    spans = runs.groupBy("bucket").applyInArrow(compare, _SPANS)
    return merged(spans)


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans of a document with the same verdict as one."""
    own = Window.partitionBy("doc_id", "text_key", "first").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= reach, 0).otherwise(1)
    island = F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spans.distinct()
        .withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy("doc_id", "text_key", "first", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("doc_id", "text_key", "start", "end", "first")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with all their columns, without passages that a document of a lesser id holds too.

    What is left around a cut is joined by the white space before the cut. `n_chars`, if there, follows the text.
    Documents of which the cuts leave no word are left out.
    """
    spans = repeated_spans(docs, length, block_bytes).where(~F.col("first"))
    spans = spans.groupBy(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.col("text_key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("key"))
    joined = rows.join(spans, ["id", "key"], "left").select("row", "spans", F.col("row.text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in textscan.parts(whole)):
            texts, spans = batch["text"].to_pylist(), batch["spans"].to_pylist()
            keep = [True] * len(texts)
            for i, own in enumerate(spans):
                if not own:
                    continue
                raw = texts[i].encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                found = textscan.words(data, np.array([0, len(data)]), textscan.SMALL_SLICE_BYTES)
                parts, at = [], 0
                for span in own:
                    begin, end = int(found.start[span["start"]]), int(found.end[span["end"] - 1])
                    parts.append(raw[at : max(at, begin)])
                    at = max(at, end)
                texts[i] = b"".join([*parts, raw[at:]]).decode()
                keep[i] = bool(texts[i].strip(" \t\n\v\f\r"))
            yield pa.record_batch([batch["row"], pa.array(texts, pa.string())], ["row", "text"]).filter(pa.array(keep, pa.bool_()))

    done = joined.mapInArrow(textscan.freeing(cut), T.StructType([T.StructField("row", joined.schema["row"].dataType), T.StructField("text", T.StringType())]))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("row.text").eqNullSafe(F.col("text")), F.col("row.n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None}
    return done.select(*[(changed[c].cast(docs.schema[c].dataType) if changed.get(c) is not None else F.col("row").getField(c)).alias(c) for c in docs.columns])
