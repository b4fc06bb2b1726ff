"""Split keys that are too large for one task into consecutive ranges of their order.

A window over ``key`` puts all rows of a key into one task. ``find_hot`` looks for keys above
a row limit in a sample of the key columns and counts the few it finds exactly;
``HotKeys.split`` parts their rows from the others and deals them out in ranges of (key, order)
of equal size, so that even one second of one key is spread over tasks. The sample only decides
on the plan: a key of the limit's size that it misses stays whole, with the same result.
Operators in ``ordered`` then work per (key, range) and hand a small summary from range to
range, so the result is the same as over the whole key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callweave.session import materialise

HOT_ROWS_SETTING = "spark.callweave.hotKeyRows"
HOT_ROWS = 2_000_000
# Rows that a key of the limit's size has in the sample on average.
SAMPLE_ROWS = 64
# Ranges for each limit's worth of rows; fewer rows than this are never worth a task. A limit
# below the usual one makes at most so many: each range costs the driver a task in every stage,
# and the sample from which their bounds are taken grows with their number.
OVERSPLIT, RANGE_ROWS, MOST_RANGES = 2, 2_000, 200

SLICE = "_slice"


@contextmanager
def hot_limit(spark: SparkSession, rows: int) -> Iterator[None]:
    """Keys above ``rows`` count as large for plans built inside the block."""
    before = spark.conf.get(HOT_ROWS_SETTING, None)
    spark.conf.set(HOT_ROWS_SETTING, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(HOT_ROWS_SETTING)
        else:
            spark.conf.set(HOT_ROWS_SETTING, before)


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of two key lists."""
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


@dataclass(frozen=True)
class HotKeys:
    keys: tuple[str, ...]
    table: DataFrame  # _h0.., stored in the shared folder
    ranges: int

    def split(self, df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """(other rows, rows of large keys): the latter have a range number that grows with
        (key, order), one range to a task. They are written with it, because Spark chooses the
        ranges by a sample that differs each time they are planned."""
        on = same_keys(
            [df[k] for k in self.keys], [self.table[f"_h{i}"] for i in range(len(self.keys))]
        )
        hot = df.join(self.table, on, "left_semi").repartitionByRange(
            self.ranges, *self.keys, *[F.col(c).asc_nulls_first() for c in order])
        hot = materialise(hot.withColumn(SLICE, F.spark_partition_id()), "ranges")
        return df.join(self.table, on, "left_anti"), hot.repartitionById(self.ranges, SLICE)


def find_hot(
    df: DataFrame, keys: Sequence[str], max_rows: int | None = None
) -> HotKeys | None:
    """Keys with more than ``max_rows`` rows, or None when every key fits one task."""
    spark = df.sparkSession
    if max_rows is None:
        max_rows = int(spark.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))
    named = df.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)])
    names = named.columns
    share = min(1.0, SAMPLE_ROWS / max_rows)
    sample = named if share == 1.0 else named.sample(share, seed=1)
    likely = materialise(sample.groupBy(*names).count().where(
        F.col("count") > share * max_rows / 2).select(*names), "likely-hot")
    if likely.isEmpty():
        return None
    counts = (
        named.join(likely.toDF(*[f"_l{i}" for i in range(len(keys))]), same_keys(
            [F.col(n) for n in names], [F.col(f"_l{i}") for i in range(len(keys))]), "left_semi")
        .groupBy(*names).agg(F.count("*").alias("_n")).where(F.col("_n") > max_rows)
    )
    table = materialise(counts, "hot")
    total = table.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    return HotKeys(tuple(keys), table.drop("_n"), range_count(total, max_rows))


def range_count(total: int, max_rows: int) -> int:
    """Ranges for ``total`` rows of large keys: as many as the limit asks for, up to
    ``MOST_RANGES``, and beyond that as many as keep a range below the usual limit."""
    wanted = ceil(total / max(max_rows, RANGE_ROWS)) * OVERSPLIT
    needed = ceil(total / max(max_rows, HOT_ROWS)) * OVERSPLIT
    return max(needed, min(wanted, MOST_RANGES))
