"""Helpers shared by the numeric operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """Column by its literal name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def valid_double(name: str) -> Column:
    """The column as DOUBLE with NaN turned into null, so that aggregates skip both."""
    return F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))


# Microseconds and offset are written out, so that different rows never share one text.
_JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_json(names: list[str], keep_nulls: bool = False) -> Column:
    """The named columns as one JSON object."""
    options = _JSON_TIMES | {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[quoted(n) for n in names]), options)


def double_lit(value: float) -> Column:
    """A DOUBLE literal; infinities and NaN go through a cast."""
    if math.isnan(value) or math.isinf(value):
        return F.lit(str(value)).cast("double")
    return F.lit(float(value))


def category_text(df_type: str, column: Column) -> Column:
    """String form of a category: null becomes the class 'None', booleans are capitalised."""
    if df_type == "boolean":
        text = F.when(column, "True").when(~column, "False")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def percent_text(share: Column) -> Column:
    """A share as a percentage with two decimals."""
    return F.format_string("%.2f%%", share * 100)


def short_decimal(value: Column) -> Column:
    """At most two decimals and at least one: 500 -> 500.0, 224.346 -> 224.35."""
    return F.regexp_replace(F.format_string("%.2f", value), "0$", "")
