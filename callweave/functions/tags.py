"""Category tags from code lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from callweave.functions.nulls import is_true


def in_list(col: Column, codes: Sequence) -> Column:
    """Membership that is false, never unknown, for a missing value."""
    return is_true(col.isin(list(codes)))


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def tag_by_list(col: Column, lists: Mapping[str, Sequence], other: str = "other") -> Column:
    """Label of the first list that holds the code."""
    out = None
    for label, codes in lists.items():
        out = (F if out is None else out).when(in_list(col, codes), label)
    return F.lit(other) if out is None else out.otherwise(other)


def rank_by_levels(col: Column, levels: Sequence[str]) -> Column:
    """Sort rank by a fixed level list; values outside the list come last."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), col)
    return F.when(pos > 0, pos).otherwise(len(levels) + 1)
