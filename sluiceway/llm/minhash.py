"""Near-duplicate groups by b-bit MinHash.

A document's set holds its distinct k-word shingles. Documents with equal sets are one node. A node has
BANDS x ROWS minima; each band's minima make a key, and nodes that share a key are candidates. Signatures
keep the lowest BITS bits of each minimum, packed into integers; the share of equal lanes, corrected for
lanes that agree by chance (2^-BITS), estimates the similarity and drops candidates that are far off.
What is left is confirmed on the full sets.

No key's members are all paired with each other. First each member meets one hub of its key; the confirmed
links make components. For the keys that hold several components, each member's own shingles (those that no
other member of such keys has) are counted: they bound every similarity it can reach. Members that cannot
reach the limit with anyone go; the others meet the member with the smallest own share; and what is then
still in different components is compared pair by pair where the bounds and the estimate allow a link. So a
group of copies does not cost its square, and no link between different components is left out.
Components are found by alternating large-star and small-star steps on tables in the shared folder.

Null texts and texts without words have an empty set and no links. A missing doc_id takes part, but does
not name a component unless no member has an id. Repeated rows are in one node. Of a component the row of
the least id stays in `without_near_duplicates`, rows without id come last, equal ids go by their text's
hash, and equal rows count as one. An empty table gives no rows; other columns are not read, whatever their
names. Texts are taken whole; a task holds one slice of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm import textscan
from sluiceway.session import to_scratch_table

SHINGLE = 4
SIMILARITY = 80  # hundredths
BANDS, ROWS, BITS = 24, 4, 4
# Minima in a signature; the first BANDS x ROWS make the bands.
MINIMA = 256
# Estimates err by 0.026 (one standard deviation, near the limit); candidates below the limit less this are dropped.
MARGIN = 0.11
_LANES = 64 // BITS
_SEEDS = textscan.mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)

PRINTS = "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, lanes array<long>"


def prints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (hash of the text), set size, node (128-bit hash of the set), band keys and b-bit signature."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in textscan.slices(batch["text"], textscan.SMALL_SLICE_BYTES):
                found, first = textscan.shingles(textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES), k)
                own, own_first = textscan.distinct(found, first)
                node = np.empty((len(first) - 1, 2), dtype=np.uint64)
                node[:, 0] = textscan.segment_sums(textscan.mix(own), own_first)
                node[:, 1] = textscan.segment_sums(textscan.mix(own ^ np.uint64(0x5851F42D4C957F2D)), own_first)
                minima = np.empty((len(first) - 1, MINIMA), dtype=np.uint64)
                for i, seed in enumerate(_SEEDS):
                    minima[:, i] = textscan.segment_minima(found * seed, first)
                minima = textscan.mix(minima)
                keys = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(minima), 1), dtype=np.uint64)
                for r in range(ROWS):
                    keys = textscan.mix(keys * np.uint64(0x9FB21C651E98DF25) + minima[:, r : BANDS * ROWS : ROWS])
                low = (minima & np.uint64((1 << BITS) - 1)).reshape(len(minima), -1, _LANES)
                lanes = (low << (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)
                n = len(node)
                yield pa.record_batch(
                    [
                        batch["doc_id"].slice(at, n),
                        batch["text_key"].slice(at, n),
                        pa.array(np.diff(own_first), pa.int64()),
                        pa.array([x.tobytes() for x in node], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(textscan.signed(keys).ravel())),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * lanes.shape[1], pa.int32()), pa.array(textscan.signed(lanes).ravel())),
                    ],
                    ["doc_id", "text_key", "n_shingles", "node", "bands", "lanes"],
                )

    return rows.mapInArrow(textscan.freeing(made), PRINTS)


def estimate(a: str, b: str) -> Column:
    """Similarity of two packed signatures: equal lanes by bit counts, less those expected to agree by chance."""
    fold = " | ".join(f"shiftrightunsigned(x, {i})" for i in range(BITS))
    ones = sum(1 << (i * BITS) for i in range(_LANES - 1))  # the top lane is counted apart: the constant stays positive
    top = 64 - BITS
    lane = f"bit_count(({fold}) & {ones}L) + IF(shiftrightunsigned(x, {top}) = 0, 0, 1)"
    different = F.expr(f"aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, (s, x) -> s + {lane})")
    same = 1 - different / F.lit(float(MINIMA))
    chance = 2.0**-BITS
    return (same - F.lit(chance)) / F.lit(1 - chance)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, similarity: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = []
                for side in ("text_a", "text_b"):
                    # A hub's text comes with each of its members: its set is made once per part.
                    coded = part[side].dictionary_encode()
                    own = []
                    for _, data, offsets in textscan.slices(coded.dictionary, limit=1 << 30):
                        values, first = textscan.distinct(*textscan.shingles(textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES), k))
                        own = [values[x:y] for x, y in zip(first[:-1], first[1:], strict=True)]
                    sets.append([own[i] for i in coded.indices.to_pylist()])
                keep = []
                for x, y in zip(*sets, strict=True):
                    short, long = (x, y) if len(x) <= len(y) else (y, x)
                    place = np.minimum(np.searchsorted(long, short), len(long) - 1)
                    both = int((long[place] == short).sum())
                    keep.append(both > 0 and 100 * both >= similarity * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(textscan.freeing(compared), "a binary, b binary")


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, least node of its component) for nodes with links, from (a, b) pairs.

    The result is a fixed point of the steps: given again as links, with new ones, it is only worked on where those join.
    """
    stars = to_scratch_table(links.toDF("a", "b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = _state(stars)
    while True:
        # Both ends of a link carry it; the least end known to a node is its neighbours' next link. Copies go once, at the end.
        both = stars.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stars.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        stars = to_scratch_table(small.select("e.*").where("u <> v").distinct(), "stars")
        state = _state(stars)
        if state == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the keys that hold more than one component, with their component's `root`."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    return placed.join(several, "key", "left_semi")


def _bounded(members: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Add `cap`: how many of a member's shingles any other member has."""

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in textscan.slices(batch["text"], textscan.SMALL_SLICE_BYTES):
                values, first = textscan.distinct(*textscan.shingles(textscan.words(data, offsets, textscan.SMALL_SLICE_BYTES), k))
                of = pa.array(np.repeat(np.arange(at, at + len(first) - 1), np.diff(first)))
                yield pa.record_batch([pa.array(textscan.signed(values)), batch["node"].take(of)], ["shingle", "node"])

    own_texts = texts.join(members.select("node").distinct(), "node", "left_semi").select("text", "node")
    shingles = own_texts.mapInArrow(textscan.freeing(exploded), "shingle long, node binary")
    single = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return members.join(own, "node", "left").withColumn("cap", F.col("size") - F.coalesce("own", F.lit(0))).drop("own")


def _reachable(size_a: str, size_b: str, similarity: int) -> Column:
    """Whether sets of at least these sizes can be similar enough, as at most `cap` of either is shared."""
    most = F.least("cap_a", "cap_b")
    return 100 * most >= similarity * F.greatest(most, F.col(size_a) + F.col(size_b) - most)


def near_duplicates(docs: DataFrame, k: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept and root (the component's own name) of every row."""
    every = to_scratch_table(prints(docs, k), "prints")
    full = every.where("n_shingles > 0")
    nodes = full.groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key", "n_shingles", "bands", "lanes")).alias("r")
    )
    keys = nodes.select("node", F.explode("r.bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1").select("key", "hub")
    shared = to_scratch_table(keys.join(hubs, "key"), "keys")

    marked = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "r.doc_id", "r.text_key")
    found = docs.select(F.col("doc_id").cast("long").alias("own_id"), "text", F.xxhash64("text").alias("own_key"))
    texts = to_scratch_table(
        found.join(marked, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")))
        .dropDuplicates(["node"])
        .select("node", "text"),
        "texts",
    )
    far = similarity / 100 - MARGIN
    about = to_scratch_table(
        nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", F.col("r.n_shingles").alias("size"), "r.lanes", "r.bands"), "about"
    )
    pairs = shared.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    for x in ("a", "b"):
        pairs = pairs.join(about.select(F.col("node").alias(x), F.col("lanes").alias(f"lanes_{x}")), x)
    roots = components(_confirmed(pairs.where(estimate("lanes_a", "lanes_b") >= far), texts, k, similarity))

    # What shares a key and isn't in one component yet.
    left = to_scratch_table(_bounded(_apart(shared.drop("hub"), roots).join(about, "node"), texts, k).where(100 * F.col("cap") >= similarity * F.col("size")), "apart")
    hub = left.groupBy("key").agg(F.min(F.struct((-F.col("cap") / F.col("size")).alias("own"), "node", "root", "lanes", "size", "cap")).alias("hub"))
    one = left.join(hub, "key").where(F.col("root") != F.col("hub.root")).select("node", "lanes", "size", "cap", "hub")
    met = one.select(*[F.col(c).alias(f"{c}_a") for c in ("node", "lanes", "size", "cap")], *[F.col(f"hub.{c}").alias(f"{c}_b") for c in ("node", "lanes", "size", "cap")])
    near = (estimate("lanes_a", "lanes_b") >= far) & _reachable("size_a", "size_b", similarity)
    met = met.where(near).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    roots = components(roots.union(_confirmed(met, texts, k, similarity)))

    left = to_scratch_table(_apart(left.drop("root"), roots), "apart")
    # Every member outside a key's largest component meets the members of the others, each pair under its first key.
    sizes = left.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    side = lambda rows, x: rows.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("root", "node", "lanes", "bands", "size", "cap")])
    rest = side(left, "a").join(main, "key").where("root_a <> main")
    first_key = F.expr("filter(zip_with(bands_a, bands_b, (p, q) -> IF(p = q, p, NULL)), x -> x IS NOT NULL)[0]")
    once = ((F.col("root_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))) & (F.col("root_a") != F.col("root_b"))
    more = rest.join(
        side(left, "b").withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & once & near & (first_key == F.col("key"))
    )
    more = more.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    roots = components(roots.union(_confirmed(more, texts, k, similarity)))

    named = nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(names, "root").select("node", "component_id", "root")
    result = every.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root"
    )


def without_near_duplicates(docs: DataFrame, k: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each group, with all its columns; of repeated rows one stays."""
    least = F.lit(np.iinfo(np.int64).min)
    found = near_duplicates(docs, k, similarity).select(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key").alias("r"), "root")
    first = found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("r").alias("r")).select("r")
    kept = first.union(found.where(F.col("root").isNull()).select("r")).select(F.coalesce("r.doc_id", least).alias("id"), F.col("r.text_key").alias("key"))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), least).alias("id"), F.xxhash64("text").alias("key"))
    return rows.join(kept.distinct(), ["id", "key"], "left_semi").dropDuplicates(["id", "key"]).select("row.*")
