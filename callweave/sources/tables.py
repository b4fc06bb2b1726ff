"""Reading tables and time slices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(
    spark: SparkSession, name: str, *, root: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table by name: a Parquet file or folder under ``root``, a table of a relational
    store (``jdbc`` options: url, and partition column with bounds for a parallel read), or a
    table of the session's catalog."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(**{**jdbc, "dbtable": name}).load()
    if root is not None:
        return spark.read.parquet(f"{root}/{name}.parquet")
    return spark.table(name)


def time_slice(df: DataFrame, time: str, start, end) -> DataFrame:
    """Rows with ``start <= time < end``. The bounds are literals of the column's type, so
    the filter reaches the Parquet scan."""
    kind = df.schema[time].dataType
    lo, hi = (F.lit(_text(v)).cast(kind) for v in (start, end))
    return df.where((F.col(time) >= lo) & (F.col(time) < hi))


def covering(df: DataFrame, start_col: str, end_col: str, start, end,
             columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose validity covers the whole run window, with only the named columns."""
    lo = F.lit(_text(start)).cast(df.schema[start_col].dataType)
    hi = F.lit(_text(end)).cast(df.schema[end_col].dataType)
    out = df.where((F.col(start_col) <= lo) & (F.col(end_col) >= hi))
    return out if columns is None else out.select(*columns)


def high_water_day(df: DataFrame, time: str) -> dt.date | None:
    """Day of the newest row, read as one value."""
    return df.agg(F.to_date(F.max(time))).first()[0]


def _text(value) -> str:
    return str(value)
