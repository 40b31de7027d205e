"""Seeded shuffle with exact split sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.functions.columns import quoted, row_json
from sluiceway.operators.ranking import KeyCut, before_cut, cuts_after, repeat_row


def row_digest(df: DataFrame) -> Column:
    """Digest of a whole row."""
    return F.md5(row_json(sorted(df.columns), keep_nulls=True))


def shuffle_key(df: DataFrame, id_col: str | None, seed: int) -> Column:
    """Pseudo-random but repeatable order: digest of the id (or of the whole row) and the seed."""
    base = quoted(id_col).cast("string") if id_col else row_digest(df)
    return F.md5(F.concat(F.coalesce(base, F.lit("")), F.lit(f":{seed}")))


def with_split(
    df: DataFrame,
    id_col: str | None = None,
    train: float = 0.8,
    val: float = 0.1,
    seed: int = 42,
    split_col: str = "split",
) -> DataFrame:
    """Add a split column: the first int(n*train) rows in shuffled order, then int(n*val), the rest test.

    Only the two border digests are searched (counts by digest prefix); the rows themselves are
    labelled by a projection with two literals and are never shuffled. Rows equal on the border are
    told apart by the digest of the whole row; complete copies on the border, which nothing can tell
    apart, are divided by number.
    """
    key, tie = shuffle_key(df, id_col, seed), row_digest(df)
    cuts = cuts_after(df, key, tie, lambda n: [int(n * train), int(n * train) + int(n * val)])
    label = (
        F.when(before_cut(cuts[0], key, tie), "train").when(before_cut(cuts[1], key, tie), "val").otherwise("test")
    )
    divided = [c for c in cuts if c is not None and c.splits_copies]
    if not divided:
        return df.withColumn(split_col, label)

    parts = []
    on_border = F.lit(False)
    for group in {(c.key, c.tie): c for c in divided}.values():
        here = (key == group.key) & (tie == group.tie)
        on_border = on_border | here
        row = df.where(here).limit(1)
        for name, copies in _copies_per_split(cuts, group).items():
            parts.append(repeat_row(row, copies).withColumn(split_col, F.lit(name)))
    return reduce(DataFrame.unionByName, parts, df.where(~on_border).withColumn(split_col, label))


def _copies_per_split(cuts: list[KeyCut | None], group: KeyCut) -> dict[str, int]:
    """How many of the identical rows on a border go to each split."""
    upto = []
    for cut in cuts:
        same = cut is not None and (cut.key, cut.tie) == (group.key, group.tie)
        after = cut is not None and (cut.key, cut.tie or "g") > (group.key, group.tie)
        upto.append(cut.copies_before if same else group.copies if after else 0)
    return {"train": upto[0], "val": upto[1] - upto[0], "test": group.copies - upto[1]}


def split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames."""
    labelled = with_split(df, **options)
    name = options.get("split_col", "split")
    return tuple(labelled.where(F.col(name) == part).drop(name) for part in ("train", "val", "test"))


def split_counts(df: DataFrame, split_col: str = "split", also: Sequence[Column] = ()) -> DataFrame:
    """Rows per split, and further aggregates of the same pass."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"), *also)
