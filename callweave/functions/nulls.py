"""NULL-aware expression helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

NA_TEXT = "NA"


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def greatest_strict(*cols: Column) -> Column:
    """Row-wise greatest that is NULL as soon as one input is NULL."""
    return F.when(~_any_null(list(cols)), F.greatest(*cols))


def least_strict(*cols: Column) -> Column:
    """Row-wise least that is NULL as soon as one input is NULL."""
    return F.when(~_any_null(list(cols)), F.least(*cols))


def if_else(cond: Column, yes, no) -> Column:
    """Two-way conditional: an unknown condition gives NULL."""
    return F.when(cond, yes).when(~cond, no)


def is_true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def text_or_na(col: Column) -> Column:
    """Text of a value, with a missing value printed as ``NA``."""
    return F.coalesce(col.cast("string"), F.lit(NA_TEXT))


def paste(*cols: Column) -> Column:
    """Concatenate; a missing part becomes the text ``NA`` instead of hiding the row."""
    return F.concat(*[text_or_na(c) for c in cols])


def update_where(cond: Column, new: Column, old: Column) -> Column:
    return F.when(cond, new).otherwise(old)


def keep_unless(cond: Column) -> Column:
    """Row filter of a conditional delete: rows with an unknown condition stay."""
    return ~is_true(cond)
