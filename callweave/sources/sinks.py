"""Rerunnable writes: replace a time slice, upsert by key, append.

A target is a folder of versions, each of which holds some days as Parquet, and a marker that
says which versions make up each day. A write stages its days as a new version and then publishes
one new marker, so readers see all of it or nothing; a write that was lost in between leaves the
table as it was, and the next write clears up after it. A rerun touches the days of its window
only; the rest of the table is neither read nor written.

The marker also holds the columns of the table, which are those of all its days. Two writers of
one table at the same time are not arbitrated beyond this: the second to publish is refused.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from callweave.session import delete_path, hadoop_path, materialise, path_exists

DAY = "slice_day"
VERSION = "slice_version"
MARKERS = "_published"
# Versions that only older markers name stay for this many markers, for reads under way.
KEEP_MARKERS = 2


@dataclass
class Published:
    """What one marker says: the versions of each day, and the columns."""

    number: int = 0
    days: dict[str, list[str]] = field(default_factory=dict)
    schema: StructType | None = None

    def folders(self, path: str, days: Sequence[str]) -> list[str]:
        return [f"{path}/{VERSION}={v}/{DAY}={d}" for d in days for v in self.days.get(d, ())]


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _marker(path: str, number: int) -> str:
    return f"{path}/{MARKERS}/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _children(spark, f"{path}/{MARKERS}")
                  if n.endswith(".json") and n[:-5].isdigit())


def _read_marker(spark: SparkSession, path: str, number: int) -> Published:
    text = spark.read.text(_marker(path, number), wholetext=True).first()[0]
    held = json.loads(text)
    return Published(number, held["days"], StructType.fromJson(held["schema"]))


def published(spark: SparkSession, path: str) -> Published:
    """The newest marker of a table; an empty one if there is none."""
    numbers = _numbers(spark, path)
    return _read_marker(spark, path, numbers[-1]) if numbers else Published()


def _publish(spark: SparkSession, path: str, state: Published) -> None:
    """Write the marker under another name and rename it, which no reader sees half done."""
    target = _marker(path, state.number)
    fs, draft = hadoop_path(spark, f"{target}.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(
        {"days": state.days, "schema": state.schema.jsonValue()}).encode()))
    out.close()
    if path_exists(spark, target) or not fs.rename(draft, hadoop_path(spark, target)[1]):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer has published marker {state.number} of {path}")


def _clear(spark: SparkSession, path: str) -> None:
    """Delete old markers, and versions that no marker left names: those of replaced days and
    those of writes that were lost before they were published."""
    numbers = _numbers(spark, path)
    named = {v for n in numbers[-KEEP_MARKERS:]
             for vs in _read_marker(spark, path, n).days.values() for v in vs}
    for n in numbers[:-KEEP_MARKERS]:
        delete_path(spark, _marker(path, n))
    for name in _children(spark, path):
        if name.startswith(f"{VERSION}=") and name.split("=", 1)[1] not in named:
            delete_path(spark, f"{path}/{name}")


def _stage(rows: DataFrame, path: str) -> tuple[str, list[str]]:
    """Write the rows as a new version, which nothing names yet; (version, its days)."""
    version = uuid.uuid4().hex
    seen = Observation("slice")
    rows.observe(seen, F.collect_set(DAY).alias("days")).write \
        .partitionBy(DAY).parquet(f"{path}/{VERSION}={version}")
    return version, sorted(seen.get["days"] or [])


def _as_stored(new: DataFrame, stored: StructType | None, more: bool = False) -> DataFrame:
    """``new`` in the columns of the stored table: columns it lacks become NULL. A column of
    another type than stored is an error, and, unless ``more`` columns are allowed, one that the
    table does not have."""
    if stored is None:
        return new
    known = {f.name.lower(): f.dataType for f in stored.fields}
    added = []
    for f in new.schema.fields:
        if f.name.lower() not in known:
            if not more:
                raise ValueError(f"the stored table has no column {f.name}")
            added.append(F.col(f"`{f.name}`"))
        elif known[f.name.lower()] != f.dataType:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()}, but stored as "
                             f"{known[f.name.lower()].simpleString()}")
    own = {f.name.lower() for f in new.schema.fields}
    return new.select(*[
        F.col(f"`{f.name}`").alias(f.name) if f.name.lower() in own
        else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields], *added)


def _columns(rows: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields])


def replace_slice(new: DataFrame, path: str, time: str, start, end) -> None:
    """Delete the target rows with ``start <= time < end``, then insert ``new``.

    Kept rows keep every stored column; a stored column that ``new`` lacks is NULL in its rows.

    Whole days of the window are replaced by the staged ones. On the first and last day of a
    window that is not aligned to midnight the rows outside the window are staged with them.
    Days of the window without rows are no longer named, as a delete would have it.
    """
    spark = new.sparkSession
    start, end = _moment(start), _moment(end)
    state = published(spark, path)
    new = _as_stored(new, state.schema)
    schema = state.schema or _columns(new)
    first, last = start.date(), (end - dt.timedelta(microseconds=1)).date()
    inside = {d for d in state.days if first.isoformat() <= d <= last.isoformat()}
    edges = {d.isoformat() for d, cut in (
        (first, start.time() != dt.time()), (last, end.time() != dt.time())) if cut}
    edges &= inside
    lo, hi = (F.lit(str(v)).cast("timestamp_ntz") for v in (start, end))
    in_window = (F.col(time) >= lo) & (F.col(time) < hi)
    # A row of another day would replace that whole day, so it is an error.
    out = new.withColumn(DAY, F.when(in_window, F.date_format(time, "yyyy-MM-dd"))
                         .otherwise(F.raise_error(F.lit("row outside the slice window"))))
    if edges:
        old = _read_days(spark, path, state, sorted(edges))
        out = out.unionByName(old.where(F.coalesce(~in_window, F.lit(True))))
    version, days = _stage(_sized(out), path)
    kept = {d: v for d, v in state.days.items() if d not in inside}
    _publish(spark, path, Published(
        state.number + 1, kept | {d: [version] for d in days}, schema))
    _clear(spark, path)


def append_slice(new: DataFrame, path: str, time: str) -> None:
    """Add rows to their days. Columns that the table lacks are added to it (NULL in its older
    rows), those that ``new`` lacks are NULL in the new rows; a row without time is an error, as
    no window would ever read it."""
    spark = new.sparkSession
    state = published(spark, path)
    new = _as_stored(new, state.schema, more=True)
    day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.raise_error(F.lit("row without time")))
    version, days = _stage(_sized(new.withColumn(DAY, day)), path)
    merged = state.days | {d: [*state.days.get(d, ()), version] for d in days}
    _publish(spark, path, Published(state.number + 1, merged, _columns(new)))
    _clear(spark, path)


def upsert(new: DataFrame, path: str, keys: Sequence[str], day: str) -> None:
    """New rows win over old rows with the same key; rows with a missing key never clash.

    ``day`` is a date column and one of ``keys``, so only the days present in ``new`` are read
    and staged again. Two new rows with one key are an error, as nothing says which is the last.
    Old rows keep every stored column; a stored column that ``new`` lacks is NULL in its rows.
    """
    if day not in keys:
        raise ValueError(f"{day} must be one of the keys")
    spark = new.sparkSession
    state = published(spark, path)
    new = _as_stored(new, state.schema)
    schema = state.schema or _columns(new)
    new = materialise(new.withColumn(DAY, F.coalesce(
        F.date_format(day, "yyyy-MM-dd"), F.raise_error(F.lit("row without day")))), "upsert-new")
    if not new.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("two new rows have the same key")
    touched = {r[0] for r in new.select(DAY).distinct().collect()}  # one value per day
    there = sorted(touched & set(state.days))
    out = new
    if there:
        old = _read_days(spark, path, state, there)
        keyed = new.select(*[F.col(k).alias(f"_u{i}") for i, k in enumerate(keys)]).distinct()
        cond = [old[k] == keyed[f"_u{i}"] for i, k in enumerate(keys)]
        out = new.unionByName(old.join(keyed, cond, "left_anti"))
    version, days = _stage(out, path)
    _publish(spark, path, Published(
        state.number + 1, state.days | {d: [version] for d in days}, schema))
    _clear(spark, path)


def read_slices(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The stored table; with ``start`` and ``end`` only the day folders that hold times with
    ``start <= time < end`` are opened. The time itself is left to the caller's filter."""
    state = published(spark, path)
    if state.schema is None:
        raise ValueError(f"no stored table at {path}")
    lo = "" if start is None else _moment(start).date().isoformat()
    hi = "9" if end is None else (_moment(end) - dt.timedelta(microseconds=1)).date().isoformat()
    return _read_days(spark, path, state, [d for d in sorted(state.days) if lo <= d <= hi]).drop(DAY)


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The high-water mark of a stored table: its newest day. A day without rows is never
    published, so no row is read."""
    days = published(spark, path).days
    return dt.date.fromisoformat(max(days)) if days else None


def _read_days(spark: SparkSession, path: str, state: Published, days: Sequence[str]) -> DataFrame:
    schema = StructType([*state.schema.fields, StructField(VERSION, StringType()),
                         StructField(DAY, StringType())])
    folders = state.folders(path, days)
    if not folders:
        return spark.createDataFrame([], schema).drop(VERSION)
    return spark.read.option("basePath", path).schema(schema).parquet(*folders).drop(VERSION)


def _sized(df: DataFrame) -> DataFrame:
    """Bring the rows of a day together in files of a good size: small days share a task,
    a large day is split over several."""
    return df.hint("rebalance", F.col(DAY))


def _moment(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))
