"""Document fingerprints by I-Match with randomised lexicons.

Terms (runs of letters and digits, A-Z lower-cased, with all characters beyond ASCII) whose document
frequency lies in a band of shares of all documents form the lexicon; too rare and too frequent terms say
little about a text. The band's lower end is a share, so the lexicon holds at most (mean distinct terms per
document) / low terms whatever the corpus: that bound is what makes its broadcast safe.

The lexicon's random subsets are fixed for the corpus, the same for every document: each of `SEEDS` random
orders of the terms gives `LEVELS` subsets, which keep all, a half, a quarter, ... of the lexicon. A document
keeps its distinct terms of the lexicon, sorted; for each subset the whole set of its terms that the subset
keeps is hashed. The fingerprint is the list of these hashes. An edit leaves the hashes of the subsets that
keep none of the terms concerned; the likeness of two fingerprints is the share of equal hashes at the
sparsest two levels where at least half of the subsets keep a term of either.

Texts without a term of the lexicon are fingerprinted by all their terms in order and are alike only if
those are equal. Null texts are empty; repeated rows have equal fingerprints; equal ids follow each other by
their text's hash, missing ids come first; an empty table gives an empty result. Other columns than doc_id
and text are not read, whatever their names. Texts are taken whole; a task holds one slice of whole texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm import textscan

LOW, HIGH = 0.001, 0.1
SEEDS, LEVELS = 24, 14
PARTITION_BYTES = 8 << 20


_TERM = np.zeros(256, dtype=np.uint8)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def document_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all terms in order, documents' first places and the end)."""
    starts, ends = textscan.runs(_TERM[data], offsets)
    return textscan.span_hashes(textscan.lowered(data), starts, ends), np.searchsorted(starts, offsets)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term hash, number of documents with it) over all documents; tasks sum before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            terms, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(textscan.signed(terms)), pa.array(n.astype(np.int64))], ["term", "n"])

        for batch in batches:
            for _, data, offsets in textscan.slices(batch["text"]):
                terms, _ = textscan.distinct(*document_terms(data, offsets))
                held.append(terms)
                size += len(terms)
                if size > 4_000_000:
                    yield summed()
                    size = 0
        if held:
            yield summed()

    return docs.select("text").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band; their number is bounded by `low` (see above)."""
    total = docs.count()
    band = document_frequencies(docs).where((F.col("n") >= max(2, math.ceil(low * total))) & (F.col("n") <= high * total))
    terms = band.select("term").toArrow()["term"].to_numpy()
    return np.sort(np.ascontiguousarray(terms).view(np.uint64))


_SEEDS = textscan.mix(np.arange(1, SEEDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_LAST = np.array([LEVELS - 1 if not i else LEVELS - i.bit_length() for i in range(1 << LEVELS)], dtype=np.int64)


def subset_hashes(terms: np.ndarray) -> np.ndarray:
    """16-bit hash of the terms that each subset keeps, (levels, seeds); 0 where it keeps none."""
    parts = []
    for part in range(0, len(terms), 1 << 14):
        at = textscan.mix(terms[part : part + (1 << 14), None] ^ _SEEDS[None, :])
        last = _LAST[(at >> np.uint64(64 - LEVELS)).astype(np.int64)]  # the sparsest subset that keeps the term
        cell = (last * SEEDS + np.arange(SEEDS)).ravel()
        halves = ((at >> np.uint64(32)).ravel(), (at & np.uint64(0xFFFFFFFF)).ravel())
        parts.append([np.bincount(cell, x, LEVELS * SEEDS) for x in (*halves, np.ones(len(cell)))])  # exact: below 2^53
    high, low, n = (sum(x).reshape(LEVELS, SEEDS)[::-1].cumsum(axis=0)[::-1] for x in zip(*parts, strict=True))
    sums = (high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64)
    filled = n > 0
    short = (textscan.mix(sums) >> np.uint64(48)).astype(">u2")
    return np.where(filled, np.maximum(short, 1), 0).astype(">u2")


def fingerprints(data: np.ndarray, offsets: np.ndarray, terms: np.ndarray) -> list[str]:
    """Fingerprint of each text of a slice."""
    sequence, at = document_terms(data, offsets)
    every, first = textscan.distinct(sequence, at)
    kept = np.zeros(len(every), dtype=bool)
    if len(terms):
        kept = terms[np.minimum(np.searchsorted(terms, every), len(terms) - 1)] == every
    total = np.concatenate([[0], np.cumsum(kept)])[first]
    every = every[kept]
    out = []
    for d, (a, b) in enumerate(zip(total[:-1].tolist(), total[1:].tolist(), strict=True)):
        if a == b:
            out.append("w:" + hashlib.md5(sequence[at[d] : at[d + 1]].tobytes()).hexdigest())
        else:
            out.append(subset_hashes(every[a:b]).tobytes().hex())
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal hashes at the sparsest two levels where at least half of the subsets keep a term of either; 1 if all is equal."""
    if a == b:
        return 1.0
    if a.startswith("w:") or b.startswith("w:"):
        return 0.0
    p, q = (np.frombuffer(bytes.fromhex(x), dtype=">u2").reshape(LEVELS, SEEDS) for x in (a, b))
    filled = (p != 0) | (q != 0)
    level = int(np.flatnonzero(2 * filled.sum(axis=1) >= SEEDS)[-1])  # level 0 keeps all terms
    some = slice(max(0, level - 1), level + 1)
    return float((filled & (p == q))[some].sum() / filled[some].sum())


def fingerprint_documents(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, fingerprint) of every text, without a shuffle."""
    spread = docs.sparkSession.sparkContext.broadcast(terms)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in textscan.slices(batch["text"]):
                prints = fingerprints(data, offsets, spread.value)
                yield pa.record_batch([batch["doc_id"].slice(at, len(prints)), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(part, home, doc_id, text) in parts of neighbouring ids, sorted; each part ends with the next part's first
    document (`home` false), the last one with the very first.

    Copies of an id are ordered by their text's hash. The driver holds a border and a first id per part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / partition_bytes))
    borders = np.unique(np.array(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else [], dtype=np.int64))

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        part = np.zeros(len(doc_id), dtype=np.int32)
        part[known] = np.searchsorted(borders, doc_id[known].to_numpy().astype(np.int64), side="right")
        return pd.Series(part)

    rows = rows.withColumns({"part": part_of("doc_id"), "tie": F.xxhash64("text")})
    least = rows.groupBy("part").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), "tie")).alias("f"))
    firsts = sorted((r.part, r.f.i, r.f.tie) for r in least.collect())
    halo = [(i, t, firsts[k - 1][0]) for k, (_, i, t) in enumerate(firsts)]
    halo = spark.createDataFrame(halo, "first_id long, first_tie long, before int")
    first = (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    parts = F.when(F.col("before").isNotNull(), F.array("part", "before")).otherwise(F.array("part"))
    return (
        rows.join(F.broadcast(halo), first, "left")
        .select("doc_id", "text", "tie", F.posexplode(parts).alias("copy", "part"))
        .repartition(max(1, len(borders) + 1), "part")
        .sortWithinPartitions("part", "copy", "doc_id", "tie")
        .select("part", (F.col("copy") == 0).alias("home"), "doc_id", "text")
    )


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Fingerprints of every text, of its edited text (its last quarter replaced by the next document's
    beginning), and how alike they are to each other and to the next document's."""
    spread = docs.sparkSession.sparkContext.broadcast(terms)

    def prints(texts: list[str]) -> list[str]:
        return [p for _, data, offsets in textscan.slices(pa.array(texts, pa.large_string())) for p in fingerprints(data, offsets, spread.value)]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for batch in batches:
            made = prints(batch["text"].to_pylist())
            chosen = []
            for part, home, doc_id, text, own in zip(
                batch["part"].to_pylist(), batch["home"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), made, strict=True
            ):
                if waiting and waiting[0] == part:
                    quarter = len(waiting[2]) // 4
                    edited = waiting[2][: len(waiting[2]) - quarter] + text[:quarter]
                    chosen.append((waiting[1], waiting[2], edited, waiting[3], own))
                waiting = (part, doc_id, text, own) if home else None
            if not chosen:
                continue
            ids, texts, edited, own, following = map(list, zip(*chosen, strict=True))
            changed = prints(edited)
            columns = (
                pa.array(ids, pa.int64()),
                pa.array(map(len, texts), pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                pa.array(own, pa.string()),
                pa.array(changed, pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)], pa.float64()),
            )
            yield pa.record_batch(list(columns), [x.split()[0] for x in SCHEMA.split(", ")])

    return with_next(docs).mapInArrow(compared, SCHEMA)
