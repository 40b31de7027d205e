"""Vector expressions over ARRAY columns, computed in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MIN_NORM = 1e-12


def l2_norm(vector: Column) -> Column:
    total = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(total)


def l2_normalise(vector: Column) -> Column:
    """Unit vector as ARRAY<DOUBLE>; a zero vector stays zero."""
    norms = F.array(F.greatest(l2_norm(vector), F.lit(MIN_NORM)))
    # The norm is bound to a lambda variable, else it would be computed again for every element.
    return F.flatten(F.transform(norms, lambda norm: F.transform(vector, lambda x: x.cast("double") / norm)))


def squared_l2(left: Column, right: Column) -> Column:
    gaps = F.zip_with(left, right, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)


def similarity(distance: Column) -> Column:
    """1 for an identical vector, falling with the distance."""
    return F.lit(1.0) / (F.lit(1.0) + distance)


def arg_max(vector: Column) -> Column:
    """Zero-based position of the first largest element."""
    return F.array_position(vector, F.array_max(vector)) - 1
