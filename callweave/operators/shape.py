"""Reshape and harmonise tables by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

from callweave.functions.nulls import NA_TEXT
from callweave.session import materialise


TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(),
         "double": DoubleType(), "date": DateType(), "timestamp_ntz": TimestampNTZType()}


def layout(text: str) -> StructType:
    """Declared layout from ``"name type, name type"``; needs no running session."""
    out = StructType()
    for part in text.split(","):
        name, kind = part.split()
        out = out.add(name, TYPES[kind], True)
    return out


def add_prefix(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[F.col(c).alias(prefix + c if c in wanted else c) for c in df.columns])


def without(columns: Sequence[str], drop: Sequence[str]) -> list[str]:
    """Column list from a table's metadata minus some names (audit columns)."""
    drop = set(drop)
    return [c for c in columns if c not in drop]


def _named(df: DataFrame, schema: StructType, by_position: bool) -> list[str]:
    """The column of ``df`` for each field of the layout."""
    if not by_position:
        return schema.fieldNames()
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a layout of {len(schema.fields)}")
    return df.columns


def stage_typed(df: DataFrame, schema: StructType, by_position: bool = False) -> DataFrame:
    """Load into a declared layout; values that do not fit the type become NULL. By position the
    number of columns must be that of the layout."""
    names = _named(df, schema, by_position)
    return df.select(*[
        F.col(f"`{n}`").try_cast(f.dataType).alias(f.name) for n, f in zip(names, schema.fields)
    ])


class Staged(NamedTuple):
    """``good``: rows of which every value fits, typed. ``bad``: one row for each value that does
    not: the column, the value as text, the reason and the whole row as JSON. ``counts``: rows,
    good rows, bad rows and bad values, and whether rows add up."""

    good: DataFrame
    bad: DataFrame
    counts: DataFrame


def stage_checked(df: DataFrame, schema: StructType, by_position: bool = False) -> Staged:
    """Load into a declared layout with quarantine: a row with a value that does not fit the type
    of its column goes to ``bad`` as a whole. A missing value fits every type."""
    names = _named(df, schema, by_position)

    def reason(column: Column, f: StructField) -> Column:
        kind = f.dataType.simpleString()
        number = column.cast("string").try_cast("double")
        ranged = F.lit(f.dataType.typeName() in ("integer", "long")) & number.isNotNull()
        return F.when(column.isNotNull() & column.try_cast(f.dataType).isNull(), F.when(
            ranged, f"out of range of {kind}").otherwise(f"not a value of type {kind}"))

    errors = F.array_compact(F.array(*[
        F.when(reason(F.col(f"`{n}`"), f).isNotNull(), F.struct(
            F.lit(f.name).alias("column"), F.col(f"`{n}`").cast("string").alias("text"),
            reason(F.col(f"`{n}`"), f).alias("reason"))) for n, f in zip(names, schema.fields)]))
    judged = materialise(df.withColumn("_errors", errors), "staging")
    is_good = F.size("_errors") == 0
    row = F.to_json(F.struct(*[F.col(f"`{n}`").cast("string").alias(f.name)
                               for n, f in zip(names, schema.fields)]))
    counts = judged.agg(
        F.count("*").alias("n_rows"), F.count_if(is_good).alias("n_good"),
        F.count_if(~is_good).alias("n_bad_rows"),
        F.coalesce(F.sum(F.size("_errors")), F.lit(0)).cast("long").alias("n_bad_values"))
    return Staged(
        stage_typed(judged.where(is_good).drop("_errors"), schema, by_position),
        judged.where(~is_good).select(row.alias("row"), F.explode("_errors").alias("e"))
        .select("e.*", "row"),
        counts.withColumn("adds_up", F.when(
            F.col("n_rows") == F.col("n_good") + F.col("n_bad_rows"), 1).otherwise(0)))


def harmonise(
    df: DataFrame, target: StructType, mapping: Mapping[str, Column], filler: str | None = NA_TEXT,
    distinct: bool = False,
) -> DataFrame:
    """Project a source to the common ``target`` layout.

    A column the mapping does not name gets ``filler``: text in text columns, a typed NULL
    elsewhere or when ``filler`` is None. With ``distinct`` equal rows come once; the filler, which
    is the same in all rows, is added afterwards and not moved with them.
    """
    def value(field):
        if field.name in mapping:
            return F.col(field.name)
        if filler is not None and field.dataType.typeName() == "string":
            return F.lit(filler)
        return F.lit(None).cast(field.dataType)

    named = df.select(*[mapping[f.name].cast(f.dataType).alias(f.name)
                        for f in target.fields if f.name in mapping])
    if distinct:
        named = named.distinct()
    return named.select(*[value(f).alias(f.name) for f in target.fields])


def as_text(target: StructType, columns: Sequence[str]) -> StructType:
    """The layout with some columns as text, for layouts that mix ``NA`` text and values."""
    out = StructType()
    for f in target.fields:
        out = out.add(f.name, StringType() if f.name in set(columns) else f.dataType, True)
    return out


def union_distinct(*frames: DataFrame, apart: bool = False) -> DataFrame:
    """Distinct rows of all frames. ``apart`` says that each frame is distinct by itself (see
    ``harmonise``) and shares no row with another, so that nothing needs to be moved."""
    rows = reduce(DataFrame.unionByName, frames)
    return rows if apart else rows.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_keys(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], kind: str, value: str
) -> DataFrame:
    """Wide to long, one row per present value."""
    return df.unpivot(list(ids), list(columns), kind, value).where(F.col(value).isNotNull())


def replace_subset(base: DataFrame, replacement: DataFrame, key: str) -> DataFrame:
    """Rows of ``base`` whose key is in ``replacement`` give way to the replacement rows."""
    keys = replacement.select(F.col(key).alias("_k")).distinct()
    kept = base.join(keys, base[key] == keys["_k"], "left_anti")
    return kept.unionByName(replacement)
