"""Row identity from content, and dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from callweave.session import materialise

COPIES_PER_TASK = 1_000_000


def content_key(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's values; NULL and the empty text differ."""
    parts = [
        F.when(F.col(c).isNull(), F.lit("n")).otherwise(
            F.concat(F.lit("v"), F.length(F.col(c).cast("string")), F.lit(":"),
                     F.col(c).cast("string"))
        )
        for c in columns
    ]
    return F.sha2(F.concat(*parts), 256)


def with_stable_id(df: DataFrame, name: str = "row_id", copies_per_task: int = COPIES_PER_TASK):
    """Give every row a unique id that a rerun reproduces: content key plus copy number.

    Exact copies are counted (map-side combined) and then written out again with their copy
    number, so even a third of all rows being copies of one row moves as one counted row per
    task. Very many copies are cut into runs of ``copies_per_task`` spread over tasks. A
    global row number would put the whole table into one task.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return _with_copies(counted, columns, copies_per_task) \
        .select(F.concat_ws("-", content_key(columns), "_copy").alias(name), *columns)


def _with_copies(counted: DataFrame, columns: Sequence[str], per_task: int) -> DataFrame:
    """Each row ``_n`` times, with its ``_copy`` number from 1."""
    few = counted.where(F.col("_n") <= per_task) \
        .withColumns({"_from": F.lit(1).cast("bigint"), "_to": F.col("_n")})
    many = counted.where(F.col("_n") > per_task).withColumn(
        "_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"),
                                      F.lit(per_task).cast("bigint")))
    ).withColumn("_to", F.least(F.col("_from") + per_task - 1, F.col("_n"))) \
        .repartition(*columns, "_from")
    return few.unionByName(many).withColumn("_copy", F.explode(F.sequence("_from", "_to")))


def with_dense_number(
    df: DataFrame, name: str = "row_number", order: Sequence[str] = (),
    copies_per_task: int = COPIES_PER_TASK,
) -> DataFrame:
    """Number all rows from 1 to their count without gaps; a rerun gives the same numbers.

    Rows are numbered by ``order`` and then by all other columns, missing values first. Exact
    copies are counted first. The rest is two passes: rows are dealt out in ranges of that order
    and written, then each range counts its own rows, and what the ranges before it hold is
    added. The driver sees one count for each range, and no task sees the whole table.
    """
    columns = df.columns
    by = [F.col(c).asc_nulls_first() for c in [*order, *[c for c in columns if c not in order]]]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    ranged = materialise(
        counted.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    held = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.sum("_n").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(held):
        offsets.append((part, before))
        before += held[part]
    first = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part long, _before long"))
    earlier = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(
        first, F.col("_range") == F.col("_part")).select(
        *columns, "_n", (F.col("_before") + F.col("_earlier")).alias("_start"))
    return _with_copies(placed, columns, copies_per_task).select(
        (F.col("_start") + F.col("_copy")).alias(name), *columns)
