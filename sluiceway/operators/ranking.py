"""Exact ranks and order statistics that never put a whole table into one task.

Two tools. `exact_positions` numbers every row, through one range shuffle. `cuts_after` and
`exact_quantiles` only look for the values at given ranks: they narrow a range with cheap counts and
sort just what is left inside it, so the table itself is never shuffled.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.functions.columns import quoted, valid_double
from sluiceway.session import to_scratch_table

# Rows that one task may sort once a search is narrow enough.
BRACKET_ROWS = 200_000
# Bins per range and round of a search.
ZOOM_BINS = 1024
# Spark's own bound for limiting ranks before a shuffle, and the tasks whose rows are merged at once beyond it.
GROUP_LIMIT = 1000
MERGED_TASKS = 256
# Hex digits of a digest.
DIGEST_DIGITS = 32


def exact_positions(
    df: DataFrame,
    groups: list[str],
    order: list[str],
    position: str = "pos",
    partitions: int | None = None,
) -> DataFrame:
    """Add the zero-based position of each row within its group.

    Rows are range-partitioned on (groups, order), so a hot group is spread over many tasks and
    ties on the first order column are split by the later ones. The local numbers are written with
    the rows to the shared folder: the counts and the rows then always speak of the same layout.
    Ascending, nulls first; give `order` columns that identify a row for a repeatable numbering.
    """
    keys = [*groups, *order]
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = to_scratch_table(
        df.repartitionByRange(width, *[quoted(k) for k in keys])
        .sortWithinPartitions(*[quoted(k) for k in keys])
        .withColumn("_at", F.monotonically_increasing_id()),
        "positions",
    ).withColumn("_part", F.shiftright("_at", 33))

    # One row per group and partition: at most partitions + groups rows.
    runs = placed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_part").alias("_shift_part"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_part") == F.col("_shift_part")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(shifts, same).select(
        *[quoted(c) for c in df.columns], (F.col("_at") + F.col("_shift")).alias(position)
    )


def first_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of each group in an order.

    Every task sends at most `n` rows of a group. Up to GROUP_LIMIT Spark's rank limit does that by itself;
    beyond it the rows are sorted where they are and cut after `n` of a group. What MERGED_TASKS tasks
    sent of a group is then cut again before all of a group's rows meet, so a hot group is never one
    task's work either.
    """

    def limited(rows: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")

    if n <= GROUP_LIMIT:
        return limited(df, [group])
    tasks = F.floor(F.spark_partition_id() / MERGED_TASKS)
    sorted_ = df.withColumn("_tasks", tasks).sortWithinPartitions(group, *order)
    return limited(limited(sorted_.mapInArrow(_first_of_runs(group, n), sorted_.schema), [group, "_tasks"]).drop("_tasks"), [group])


def _first_of_runs(group: str, n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by `group`, the first `n` of each; a run may go over many batches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch[group].dictionary_encode(null_encoding="encode")
            code = coded.indices.to_numpy()
            begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            place = np.arange(len(code)) - np.repeat(begin, np.diff(np.append(begin, len(code))))
            if coded.dictionary[int(code[0])].as_py() == last and seen:
                place[: begin[1] if len(begin) > 1 else len(code)] += seen
            last, seen = coded.dictionary[int(code[-1])].as_py(), int(place[-1]) + 1
            yield batch.filter(pa.array(place < n))

    return cut


def overlapping_chunks(df: DataFrame, position: str, size: int, overlap: int, chunk: str = "chunk") -> DataFrame:
    """Assign rows to chunks of `size` positions; the last `overlap` rows of a chunk are repeated in
    the next one, where they only serve as history (`home` is false for them)."""
    home = F.floor(F.col(position) / size)
    near_end = F.col(position) % size >= size - overlap
    both = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn(chunk, F.explode(both)).withColumn("home", F.col(chunk) == home)


@dataclass
class KeyCut:
    """The border after a given number of rows in the order of (key, tie).

    `key` and `tie` are hex digests. Rows with a smaller key lie before the border; among rows with
    the border's key the tie decides; of rows equal in both, `copies_before` of `copies` lie before.
    """

    key: str
    tie: str | None = None
    copies: int = 1
    copies_before: int = 1

    @property
    def splits_copies(self) -> bool:
        return self.copies_before < self.copies


def _digest_counts(keys: DataFrame, digest: Column, prefixes: list[str], width: int) -> list:
    """(prefix of `width` digits, rows) below the given shorter prefixes, in order."""
    inside = keys.where(F.substring(digest, 1, len(prefixes[0])).isin(prefixes)) if prefixes[0] else keys
    counts = inside.groupBy(F.substring(digest, 1, width).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((row.p, row.n) for row in counts.collect())


def _digests_at_ranks(keys: DataFrame, digest: Column, ranks_of: Callable[[int], list[int]]) -> dict:
    """{rank: (digest, rows before it, rows that share it)} for 1-based ranks chosen from the row count.

    Each round counts rows by four more hex digits (65,536 counters per open rank at most) and keeps
    the prefix that holds the rank; once few rows share a prefix the next round is the last.
    """
    counts = _digest_counts(keys, digest, [""], 4)
    ranks = ranks_of(sum(n for _, n in counts))
    open_ = {rank: ("", 0) for rank in ranks}
    found: dict = {}
    width = 4
    while open_:
        most = 0
        for rank, (prefix, before) in list(open_.items()):
            for p, n in counts:
                if not p.startswith(prefix):
                    continue
                if before + n >= rank:
                    open_[rank] = (p, before)
                    most = max(most, n)
                    if width == DIGEST_DIGITS:
                        found[rank] = (p, before, n)
                    break
                before += n
        if width == DIGEST_DIGITS:
            return found
        width = DIGEST_DIGITS if most <= BRACKET_ROWS else width + 4
        counts = _digest_counts(keys, digest, sorted({p for p, _ in open_.values()}), width)
    return found


def cuts_after(
    df: DataFrame, digest: Column, tie: Column, sizes_of: Callable[[int], list[int]]
) -> list[KeyCut | None]:
    """The borders after the given numbers of rows in digest order; None where no row lies before."""
    chosen: list[int] = []

    def ranks_of(n: int) -> list[int]:
        chosen.extend(sizes_of(n))
        return sorted({r for r in chosen if r > 0})

    found = _digests_at_ranks(df.select(digest.alias("k")), F.col("k"), ranks_of)
    cuts: list[KeyCut | None] = []
    for size in chosen:
        if size <= 0:
            cuts.append(None)
            continue
        key, before, same = found[size]
        wanted = size - before
        if wanted == same:
            cuts.append(KeyCut(key))
            continue
        tied = df.where(digest == key).select(tie.alias("t"))
        tie_key, tie_before, tie_same = _digests_at_ranks(tied, F.col("t"), lambda n: [wanted])[wanted]
        cuts.append(KeyCut(key, tie_key, tie_same, wanted - tie_before))
    return cuts


def before_cut(cut: KeyCut | None, digest: Column, tie: Column) -> Column:
    """Whether a row lies before the border, by literals alone (copies on the border count as before)."""
    if cut is None:
        return F.lit(False)
    if cut.tie is None:
        return digest <= cut.key
    return (digest < cut.key) | ((digest == cut.key) & (tie <= cut.tie))


def repeat_row(row: DataFrame, times: int, block: int = 100_000) -> DataFrame:
    """`times` copies of a one-row DataFrame, generated in parallel blocks."""
    blocks = math.ceil(times / block)
    if blocks == 0:
        return row.limit(0)
    spread = row.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition("_block")
    size = F.when(F.col("_block") == blocks - 1, times - block * (blocks - 1)).otherwise(block)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop("_block", "_copy")


@dataclass
class ValueRange:
    """A closed range of one column's values; `below` rows lie under it, `rows` in it."""

    column: str
    low: float
    high: float
    below: int = 0
    rows: int = 0


def finite_double(name: str) -> Column:
    """The column as DOUBLE without NaN, infinities drawn in to the largest finite values."""
    v = valid_double(name)
    largest = sys.float_info.max
    # least and greatest skip nulls, so missing values are kept out of them.
    return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(largest)), F.lit(-largest)))


def long_values(df: DataFrame, ranges: list[ValueRange], *kept: Column) -> DataFrame:
    """Long form of the columns that the ranges name: the kept columns, r (range number), v, low, high.

    One generic row shape for all columns keeps the generated code small, however many there are.
    """
    cells = [
        F.struct(
            F.lit(i).alias("r"),
            finite_double(x.column).alias("v"),
            F.lit(float(x.low)).alias("low"),
            F.lit(float(x.high)).alias("high"),
        )
        for i, x in enumerate(ranges)
    ]
    wide = df.select(*kept, F.explode(F.array(*cells)).alias("_c"))
    return wide.select(*[quoted(c) for c in wide.columns[:-1]], "_c.*").where(F.col("v").isNotNull())


def values_in_ranges(df: DataFrame, ranges: list[ValueRange], *kept: Column) -> DataFrame:
    """`long_values` without the values outside their range."""
    return long_values(df, ranges, *kept).where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))


def equal_width_bin(bins: int) -> Column:
    """Bin of v between low and high, rising with v; halves keep the widest ranges from overflowing."""
    v, low, high = F.col("v") / 2, F.col("low") / 2, F.col("high") / 2
    # A range too narrow to halve has one bin.
    place = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), place))
    return F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int")


def _magnitude(v: Column) -> Column:
    """Signed binary magnitude: rises with v, one unit per power of two, 0 for zero."""
    return F.signum(v) * (F.log2(F.greatest(F.abs(v), F.lit(5e-324))) + 1076)


def zoom_bin(bins: int) -> Column:
    """Bin of v between low and high, rising with v; low and high are never in the same one.

    A range over more than one power of two is cut evenly by magnitude, any other one evenly by value.
    """
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    narrow = ((low > 0) & (high <= 2 * low)) | ((high < 0) & (low >= 2 * high))
    m, m_low, m_high = (_magnitude(c) for c in (v, low, high))
    share = F.when(narrow, F.try_divide(v - low, high - low)).otherwise(F.try_divide(m - m_low, m_high - m_low))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(share * bins))).cast("int")


def exact_order_statistics(df: DataFrame, ranks: dict[str, list[int]], stats: dict[str, tuple]) -> dict:
    """Values at 1-based ranks of numeric columns: {(column, rank): value}.

    `stats` gives (valid rows, min, max) per column. Every round counts the rows in ZOOM_BINS bins of
    each range that still holds a wanted rank, all ranges in one pass, and goes on with the bin that
    holds it; a hot value soon fills a bin alone and is the answer. Ranges with at most BRACKET_ROWS
    rows are sorted. Whatever the distribution, two rounds lead within a power of two and six more
    through its 52 bits. Tasks send bin counters, never the values of the table.
    """
    at = {(c, r): ValueRange(c, stats[c][1], stats[c][2], 0, stats[c][0]) for c, wanted in ranks.items() for r in wanted}
    while True:
        wide = [x for x in at.values() if x.rows > BRACKET_ROWS and x.low < x.high]
        wide = list({(x.column, x.low, x.high): x for x in wide}.values())
        if not wide:
            break
        counts = (
            values_in_ranges(df, wide)
            .groupBy("r", zoom_bin(ZOOM_BINS).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        for i, whole in enumerate(wide):
            bins, before = [], whole.below
            for row in sorted((c.bin, c.low, c.high, c.n) for c in counts if c.r == i):
                bins.append(ValueRange(whole.column, row[1], row[2], before, row[3]))
                before += row[3]
            for (c, rank), x in at.items():
                if (x.column, x.low, x.high) == (whole.column, whole.low, whole.high):
                    at[c, rank] = next(b for b in bins if b.below < rank <= b.below + b.rows)
    answers = {key: x.low for key, x in at.items() if x.low == x.high}
    rest = {key: x for key, x in at.items() if x.low < x.high}
    if rest:
        answers.update(_sorted_lookup(df, rest))
    edge = sys.float_info.max
    return {key: math.copysign(math.inf, v) if abs(v) == edge else v for key, v in answers.items()}


def _sorted_lookup(df: DataFrame, rest: dict) -> dict:
    """Sort the values left in each range, copies collapsed, and read the wanted ranks."""
    ranges = list({(x.column, x.low, x.high): x for x in rest.values()}.values())
    number = {(x.column, x.low, x.high): i for i, x in enumerate(ranges)}
    counts = values_in_ranges(df, ranges).groupBy("r", "v").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.lit(False)
    upto, first = F.col("upto"), F.col("upto") - F.col("n")
    for (_, rank), x in rest.items():
        here = F.col("r") == number[x.column, x.low, x.high]
        wanted = wanted | (here & (upto >= rank - x.below) & (first < rank - x.below))
    rows = counts.withColumn("upto", F.sum("n").over(running)).where(wanted).collect()
    answers = {}
    for key, x in rest.items():
        i = number[x.column, x.low, x.high]
        place = key[1] - x.below
        answers[key] = next(r.v for r in rows if r.r == i and r.upto - r.n < place <= r.upto)
    return answers


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], stats: dict[str, tuple]) -> dict:
    """Exact quantiles with linear interpolation between neighbours: {column: [value per share]}."""
    ranks, places = {}, {}
    for c in columns:
        n = stats[c][0]
        if not n:
            continue
        for s in shares:
            at = s * (n - 1)
            places[c, s] = (math.floor(at) + 1, math.ceil(at) + 1, at - math.floor(at))
        ranks[c] = sorted({r for s in shares for r in places[c, s][:2]})
    found = exact_order_statistics(df, ranks, stats)
    result = {}
    for c in columns:
        if not stats[c][0]:
            result[c] = [None] * len(shares)
            continue
        result[c] = []
        for s in shares:
            lower, upper, part = places[c, s]
            low, high = found[c, lower], found[c, upper]
            result[c].append(low + (high - low) * part)
    return result
