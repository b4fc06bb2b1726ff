"""Counts, rates, checks and grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callweave.functions.dates import seconds_between
from callweave.functions.nulls import text_or_na
from callweave.operators.ordered import KeyLine
from callweave.operators.skew import find_hot
from callweave.session import materialise

# Characters of a piece of a list, and rows whose ids a task holds before it counts them.
PIECE_CHARS, HELD_ROWS = 1 << 20, 2_000_000


def sum0(col: Column) -> Column:
    """Sum without missing values; nothing to add gives 0."""
    return F.coalesce(F.sum(col), F.lit(0))


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100``; NULL when the whole is zero."""
    p, w = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.try_divide(p.cast("double"), w.cast("double")) * 100


def rate_report(
    df: DataFrame, by: Sequence[str], counts: Mapping[str, Column],
    rates: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Counts per group in one aggregate, then percentages of them."""
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()]) if by else \
        df.agg(*[c.alias(n) for n, c in counts.items()])
    return out.withColumns({n: percent(a, b) for n, (a, b) in rates.items()})


def mean_gap_seconds(a: Column, b: Column) -> Column:
    """Absolute value of the mean gap in whole seconds, 0 when there is none."""
    return F.coalesce(F.abs(F.avg(seconds_between(a, b))), F.lit(0.0))


def text_list(value: Column, order: Sequence[Column], sep: str = ",") -> Column:
    """Texts of a group in ``order``, joined; a missing value prints as ``NA``.

    The result is one text per group, so it belongs on small groups such as one call.
    """
    items = F.sort_array(F.collect_list(F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(order)], text_or_na(value).alias("v"))))
    return F.array_join(F.transform(items, lambda x: x["v"]), sep)


def text_pieces(
    df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str], sep: str = ",",
    size: int = PIECE_CHARS,
) -> DataFrame:
    """(keys, piece, offset, text): the list of each group in pieces of about ``size`` characters.

    The texts of a group in the order of ``piece`` make up what ``text_list`` gives; ``offset`` is
    where a piece begins in it. A value belongs to the piece in which it begins, which the running
    length of the values before it tells, so a group of any size is written by many tasks and no
    value of the result outgrows ``size`` by more than one item. ``order`` must be unique in a
    group, or the rest of the row identical.
    """
    rows = df.withColumn("_v", text_or_na(value))
    width = F.length("_v") + len(sep)
    line = KeyLine(rows, keys, order, hot=find_hot(rows, keys)).run(
        sums={"_start": width.cast("bigint")}, include_current=False)
    # The separator goes before each item but the first.
    item = F.when(F.col("_start") == 0, F.col("_v")).otherwise(F.concat(F.lit(sep), "_v"))
    placed = line.rows().select(
        *keys, F.floor(F.col("_start") / size).alias("piece"), F.col("_start"), item.alias("_item"))
    return placed.groupBy(*keys, "piece").agg(
        F.min("_start").alias("_from"),
        F.array_sort(F.collect_list(F.struct("_start", "_item"))).alias("_items")
    ).select(*keys, "piece", F.greatest(F.col("_from") - len(sep), F.lit(0)).alias("offset"),
             F.array_join(F.transform("_items", lambda x: x["_item"]), "").alias("text"))


def unique_check(df: DataFrame, ids: Mapping[str, str]) -> DataFrame:
    """One row per checked id: rows, distinct values and whether each is unique.

    One pass over ``df`` hashes all ids; a task counts its hashes before it sends them on, so no
    row is repeated for each id and wide values do not move. A hash seen once is one value. Only
    the rows of hashes seen more often are looked at again, by their values, which also settles
    two values with one hash.
    """
    names, columns = list(ids), list(ids.values())
    hashed = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(f"h{i}")
                         for i, c in enumerate(columns)])

    def partial(batches):
        import numpy as np
        import pyarrow as pa

        held, size = [[] for _ in columns], 0

        def counted():
            for i, parts in enumerate(held):
                if parts:
                    found, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(np.full(len(found), i, np.int32)), "h": pa.array(found),
                        "n": pa.array(n.astype(np.int64))})
                    parts.clear()

        for batch in batches:
            for parts, column in zip(held, batch.columns):
                parts.append(column.drop_null().to_numpy())
            size += batch.num_rows
            if size >= HELD_ROWS:
                yield from counted()
                size = 0
        yield from counted()

    seen = materialise(
        hashed.mapInArrow(partial, "id int, h long, n long").groupBy("id", "h")
        .agg(F.sum("n").alias("n")), "seen-ids")
    once = F.col("n") == 1
    found = {r["id"]: r for r in seen.groupBy("id").agg(
        F.sum("n").alias("rows"), F.count_if(once).alias("single"),
        F.count_if(~once).alias("several")).collect()}
    out = []
    for i, (name, c) in enumerate(zip(names, columns)):
        rows, single = (found[i]["rows"], found[i]["single"]) if i in found else (0, 0)
        if i in found and found[i]["several"]:
            again = seen.where((F.col("id") == i) & ~once).select(F.col("h").alias("_h"))
            values = df.select(F.col(c).alias("_v")).where(F.col("_v").isNotNull()) \
                .join(again, F.xxhash64("_v") == F.col("_h"), "left_semi")
            distinct = values.groupBy("_v").agg(F.lit(1)).agg((F.count("*") + single).alias("d"))
        else:
            distinct = df.sparkSession.range(1).select(F.lit(single).cast("long").alias("d"))
        out.append(distinct.select(
            F.lit(name).alias("check_name"), F.lit(rows).cast("long").alias("n_rows"),
            F.col("d").alias("n_distinct"),
            F.when(F.col("d") == rows, 1).otherwise(0).alias("is_unique")))
    return reduce(DataFrame.unionByName, out)


def count_check(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a step that must not change them."""
    side = lambda df, b, a: df.agg(F.count("*").alias("n")).select(
        (F.col("n") * b).alias("b"), (F.col("n") * a).alias("a"))
    return side(before, 1, 0).unionByName(side(after, 0, 1)).agg(
        F.sum("b").alias("n_before"), F.sum("a").alias("n_after")
    ).select(F.lit(name).alias("check_name"), "n_before", "n_after",
             F.when(F.col("n_before") == F.col("n_after"), 1).otherwise(0).alias("is_equal"))


def unmatched_by_day(df: DataFrame, time: str, looked_up: str) -> DataFrame:
    return df.where(F.col(looked_up).isNull()).groupBy(F.to_date(time).alias("day")) \
        .agg(F.count("*").alias("n_unmatched"))
