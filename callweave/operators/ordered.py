"""Ordered per-key operators: running last / max / count, next event, row numbers.

Every function costs one shuffle on the key and one sort. Frames always start at the first
row of the partition, so the work is linear in the rows; nothing looks ahead over an
unbounded frame. With ``hot`` (see ``skew``) large keys are worked on slice by slice.

``null_keys`` says what a missing key means: ``"group"`` treats NULL as a value of its own,
``"never"`` relates such rows to no other row and leads them round the windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from callweave.operators.skew import SLICE, HotKeys, same_keys


def _sorted(order: Sequence[str], backwards: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if backwards else F.col(c).asc_nulls_first() for c in order]


# Rows that a task of a line of wide rows sorts.
TASK_ROWS = 100_000


def tasks_for(df: DataFrame) -> int | None:
    """Tasks for the rows of ``df`` at ``TASK_ROWS`` each, so that what a task sorts does not grow
    with the table; None where Spark's default parallelism keeps them smaller."""
    wanted = ceil(df.count() / TASK_ROWS)
    return wanted if wanted > df.sparkSession.sparkContext.defaultParallelism else None


class KeyLine:
    """The rows of each key in order. Several passes over one line share its shuffle.

    With ``null_keys="never"`` rows with a missing key are set apart and united with the others
    at the end: their running values are NULL, their counts and sums 0. Rows of large keys are a part of
    their own, in ranges of the order. ``tasks`` is the number of tasks the other keys are dealt to,
    if it is not left to Spark (see ``tasks_for``).
    """

    def __init__(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
        hot: HotKeys | None = None, null_keys: str = "group", tasks: int | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        self._never, self._rest, self._hot = null_keys == "never", None, None
        if self._never:
            known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            self._rest, df = df.where(~known), df.where(known)
        if hot is not None:
            df, self._hot = hot.split(df, self.order)
        self._df = df if tasks is None else df.repartition(tasks, *self.keys)

    def run(
        self, *, last: Mapping[str, Column] | None = None,
        largest: Mapping[str, Column] | None = None, counts: Mapping[str, Column] | None = None,
        sums: Mapping[str, Column] | None = None, backwards: bool = False,
        include_current: bool = True,
    ) -> KeyLine:
        """Add running values per key.

        ``last``: nearest non-NULL value so far; ``largest``: largest value so far;
        ``counts``: number of non-NULL values so far; ``sums``: sum of whole numbers so far, 0 at
        the start. ``backwards`` runs from the last row to the first, so the nearest value so far
        is the next one in time.
        """
        last, largest, counts = dict(last or {}), dict(largest or {}), dict(counts or {})
        sums = dict(sums or {})

        def running(df: DataFrame, by: Sequence[str]) -> DataFrame:
            frame = (
                Window.partitionBy(*by).orderBy(*_sorted(self.order, backwards))
                .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
            )
            return df.withColumns({
                **{n: F.last(c, ignorenulls=True).over(frame) for n, c in last.items()},
                **{n: F.max(c).over(frame) for n, c in largest.items()},
                **{n: F.count(c).over(frame) for n, c in counts.items()},
                **{n: F.coalesce(F.sum(c).over(frame), F.lit(0)) for n, c in sums.items()},
            })

        self._df = running(self._df, self.keys)
        if self._hot is not None:
            self._hot = self._carry(
                self._hot, running(self._hot, [*self.keys, SLICE]), last, largest, counts, sums, backwards)
        if self._rest is not None:
            kinds = self._df.schema
            self._rest = self._rest.withColumns({
                **{n: F.lit(None).cast(kinds[n].dataType) for n in (*last, *largest)},
                **{n: F.lit(0).cast("bigint") for n in (*counts, *sums)}})
        return self

    def _carry(self, before, out, last, largest, counts, sums, backwards) -> DataFrame:
        """Add to each range of a large key what its earlier ranges hold.

        The edge table has one row per key and range; its windows combine prefixes.
        """
        place = F.struct(*self.order)
        pick = F.min_by if backwards else F.max_by
        e_keys = [f"_e{i}" for i in range(len(self.keys))]
        edges = before.groupBy(
            *[F.col(k).alias(e) for k, e in zip(self.keys, e_keys)], F.col(SLICE).alias("_es")
        ).agg(*[pick(c, F.when(c.isNotNull(), place)).alias(f"_c_{n}") for n, c in last.items()],
              *[F.max(c).alias(f"_c_{n}") for n, c in largest.items()],
              *[F.count(c).alias(f"_c_{n}") for n, c in counts.items()],
              *[F.sum(c).alias(f"_c_{n}") for n, c in sums.items()])
        earlier = (
            Window.partitionBy(*e_keys)
            .orderBy(F.desc("_es") if backwards else F.asc("_es"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        edges = edges.withColumns({
            **{f"_c_{n}": F.last(f"_c_{n}", ignorenulls=True).over(earlier) for n in last},
            **{f"_c_{n}": F.max(f"_c_{n}").over(earlier) for n in largest},
            **{f"_c_{n}": F.sum(f"_c_{n}").over(earlier) for n in (*counts, *sums)},
        })
        left = [*[out[k] for k in self.keys], out[SLICE]]
        right = [*[edges[e] for e in e_keys], edges["_es"]]
        return out.join(edges, same_keys(left, right), "left").withColumns({
            **{n: F.coalesce(n, f"_c_{n}") for n in last},
            **{n: F.greatest(n, f"_c_{n}") for n in largest},
            **{n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in (*counts, *sums)},
        }).drop(*edges.columns)

    def with_columns(self, columns: Mapping[str, Column]) -> KeyLine:
        self._df = self._df.withColumns(dict(columns))
        if self._hot is not None:
            self._hot = self._hot.withColumns(dict(columns))
        if self._rest is not None:
            self._rest = self._rest.withColumns(dict(columns))
        return self

    def rows(self) -> DataFrame:
        out = self._df
        if self._hot is not None:
            out = out.unionByName(self._hot.drop(SLICE))
        return out if self._rest is None else out.unionByName(self._rest)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, str],
    *,
    hot: HotKeys | None = None,
    null_keys: str = "group",
) -> DataFrame:
    """Values of the next row of the key (``{new name: column}``), NULL at the end.

    This is the self-join "row n with row n + 1" written as one ordered pass.
    """
    if hot is None and null_keys == "group":
        w = Window.partitionBy(*keys).orderBy(*_sorted(order, False))
        return df.withColumns({n: F.lead(c).over(w) for n, c in values.items()})
    row = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    line = KeyLine(df, keys, order, hot=hot, null_keys=null_keys)
    out = line.run(last={"_next": row}, backwards=True, include_current=False).rows()
    return out.withColumns({n: F.col(f"_next.{n}") for n in values}).drop("_next")


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    *,
    backwards: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Number the rows of each key from 1; NULL is a key of its own."""
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*_sorted(order, backwards))
        return df.withColumn(name, F.row_number().over(w))
    line = KeyLine(df, keys, order, hot=hot)
    return line.run(counts={name: F.lit(1)}, backwards=backwards).rows()


def with_next_or_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    default_from: str,
    default_plus: str,
    name: str,
    *,
    hot: HotKeys | None = None,
    strict: bool = False,
) -> DataFrame:
    """Next ``value`` of the key; for the last row the largest ``default_from`` of the key
    plus an interval. The running maximum of the last row is the maximum of the key, so no
    second pass over the key is needed. Missing values of ``default_from`` are left out of
    the maximum; with ``strict`` one of them makes it missing. Without large keys one sort serves
    the next row and the running values."""
    after = F.struct(F.col(value).alias("v"))
    line = KeyLine(df, keys, order, hot=hot)
    if hot is None:
        line.with_columns({"_next": F.lead(after).over(
            Window.partitionBy(*keys).orderBy(*_sorted(order, False)))})
    else:
        line.run(last={"_next": after}, backwards=True, include_current=False)
    out = line.run(largest={"_max": F.col(default_from)},
                   counts={"_lost": F.when(F.col(default_from).isNull(), 1)}).rows()
    end = F.col("_max") + F.expr(default_plus)
    if strict:
        end = F.when(F.col("_lost") == 0, end)
    return out.withColumn(name, F.when(F.col("_next").isNotNull(), F.col("_next.v")).otherwise(end)) \
        .drop("_next", "_max", "_lost")


def with_group_max(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Largest value of the key on every row.

    Aggregate first (map-side combined), then join: a window would hold the whole key in
    one task. The join can be split by AQE when a key is large.
    """
    top = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]) \
        .agg(F.max(value).alias(name))
    on = same_keys([df[k] for k in keys], [top[f"_g{i}"] for i in range(len(keys))])
    return df.join(top, on, "left").drop(*[f"_g{i}" for i in range(len(keys))])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    Spark limits each map task to one row per key before the shuffle (window group limit),
    so a key of any size reaches the final task as one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_best(df: DataFrame, id_col: str, order: Sequence[Column]) -> DataFrame:
    """One row per id, the first in ``order``; rows without an id are all kept.

    The rows without id go around the window: together they would be one group.
    """
    best = first_per_group(df.where(F.col(id_col).isNotNull()), [id_col], order)
    return best.unionByName(df.where(F.col(id_col).isNull()))
