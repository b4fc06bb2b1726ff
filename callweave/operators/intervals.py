"""Match points in time to intervals of the same key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callweave.operators.ordered import KeyLine
from callweave.operators.skew import find_hot

# Points of a key that are numbered one after the other and joined as one block.
BLOCK = 256


def _time_line(left, right, on, lo, hi, time, right_id):
    """Left rows at the end of their interval and right rows at their time, one table.

    A left row sorts before right rows of the same time, so that it only sees right rows
    strictly before its end.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    l_row = F.struct(*left.columns)
    r_row = F.struct(*right.columns)
    l_type, r_type = left.schema, right.schema
    id_type = right.schema[right_id].dataType
    usable = F.col(lo) < F.col(hi)  # an empty or unknown interval matches nothing
    ends = left.select(
        *[F.when(usable, F.col(l)).alias(k) for k, (l, _) in zip(keys, on)],
        F.col(hi).alias("_t"), F.lit(0).alias("_kind"),
        F.lit(None).cast(id_type).alias("_id"),
        l_row.alias("_left"), F.lit(None).cast(r_type).alias("_right"),
    )
    points = right.where(F.col(time).isNotNull()).dropna(subset=[r for _, r in on]).select(
        *[F.col(r).alias(k) for k, (_, r) in zip(keys, on)],
        F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.col(right_id).alias("_id"),
        F.lit(None).cast(l_type).alias("_left"), r_row.alias("_right"),
    )
    return ends.unionByName(points), keys


def match_last(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    lo: str,
    hi: str,
    time: str,
    right_id: str,
    *,
    differ: tuple[str, str] | None = None,
    may_be_hot: bool = True,
) -> DataFrame:
    """All left rows, each with the last right row of its key with ``lo <= time < hi``.

    The last right row in the interval is the last one before ``hi``, provided it is not
    before ``lo``. So both sides are put on one time line per key and the nearest earlier
    right row is carried along: one shuffle, linear work, no candidate pairs. ``differ``
    (left column, right column) only accepts right rows whose column has another value; for
    that the line also carries the last right row that differs from the nearest one.

    Missing keys never match. Right columns are added to the left ones; names must differ.
    ``right_id`` breaks ties of time, the largest id counts as last. ``may_be_hot=False``
    skips the search for large keys when the caller has found that there is none.
    """
    if differ is not None:  # a missing value differs from nothing
        right = right.where(F.col(differ[1]).isNotNull())
    line, keys = _time_line(left, right, on, lo, hi, time, right_id)
    hot = find_hot(line.dropna(subset=keys), keys) if may_be_hot else None
    line = KeyLine(line, keys, ["_t", "_kind", "_id"], hot=hot, null_keys="never")
    if differ is None:
        line.run(last={"_hit": F.col("_right")})
    else:
        l_col, r_col = differ
        line.run(last={"_prev": F.col("_right")}, include_current=False)
        other = F.when(F.col(f"_right.{r_col}") != F.col(f"_prev.{r_col}"), F.col("_prev"))
        line.run(last={"_near": F.col("_right"), "_other": other})
        same = F.col(f"_near.{r_col}") == F.col(f"_left.{l_col}")
        line.with_columns({"_hit": F.when(~same, F.col("_near")).when(same, F.col("_other"))})
    inside = F.col(f"_hit.{time}") >= F.col(f"_left.{lo}")
    return line.rows().where("_kind = 0").select(
        "_left.*", *[F.when(inside, F.col(f"_hit.{c}")).alias(c) for c in right.columns]
    )


def all_pairs(
    intervals: DataFrame,
    points: DataFrame,
    on: Sequence[tuple[str, str]],
    lo: str,
    hi: str,
    time: str,
    *,
    keep: str | None = None,
    open_start: bool = False,
    closed_end: bool = False,
    null_safe: bool = False,
    may_be_hot: bool = True,
) -> DataFrame:
    """Every pair of an interval and a point of its key inside it, all columns of both.

    An endpoint sweep: the ends of the distinct intervals and the points go on one line per key,
    and the number of points so far is carried along. An interval then holds the points numbered
    from its first end's number up to its second's. Points are cut into blocks of ``BLOCK``
    numbers; an interval joins the blocks it holds points of. All blocks but the first and the
    last are held in full, so the work follows the pairs, however long an interval is, and a
    dense second is cut as well.

    Inside is ``lo <= time < hi`` (``lo < time`` if ``open_start``, ``time <= hi`` if
    ``closed_end``). ``keep`` ("intervals" or "points") also keeps the rows of that side that
    match nothing. Missing ends, times and (unless ``null_safe``) keys match nothing. Column
    names must differ.
    """
    i_keys, p_keys = [i for i, _ in on], [p for _, p in on]
    names = [f"_k{n}" for n in range(len(on))]
    kinds = {intervals.schema[lo].dataType, intervals.schema[hi].dataType, points.schema[time].dataType}
    moment = (lambda c: F.col(c)) if len(kinds) == 1 else (lambda c: F.col(c).cast("timestamp_ntz"))

    start, end = moment(lo), moment(hi)
    usable = (start <= end) if closed_end and not open_start else (start < end)
    spans = intervals.where(usable).select(
        *[F.col(c).alias(n) for c, n in zip(i_keys, names)], start.alias("_lo"), end.alias("_hi"))
    known = spans if null_safe else spans.dropna(subset=names)
    # A start comes before the points of its time, unless it is open; an end as well, unless it
    # is closed.
    ends = F.array(F.struct(F.col("_lo").alias("t"), F.lit(2 if open_start else 0).alias("at")),
                   F.struct(F.col("_hi").alias("t"), F.lit(2 if closed_end else 0).alias("at")))
    events = known.distinct().select(*names, "_lo", "_hi", F.posexplode(ends).alias("_side", "_e"))

    placed = points.where(F.col(time).isNotNull()).select(
        *[F.col(c).alias(n) for c, n in zip(p_keys, names)], moment(time).alias("_t"),
        F.lit(1).alias("_at"), F.xxhash64(*points.columns).alias("_id"),
        F.struct(*points.columns).alias("_point"))
    marks = events.select(*names, F.col("_e.t").alias("_t"), F.col("_e.at").alias("_at"),
                          "_lo", "_hi", "_side")
    both = placed.unionByName(marks, allowMissingColumns=True)
    hot = None
    if may_be_hot:
        hot = find_hot(both if null_safe else both.dropna(subset=names), names)

    def line(df: DataFrame) -> DataFrame:
        return KeyLine(df, names, ["_t", "_at", "_id"], hot=hot,
                       null_keys="group" if null_safe else "never").run(
            counts={"_n": F.when(F.col("_at") == 1, 1)}).rows()

    numbers = line(both.drop("_point")).where("_side IS NOT NULL").groupBy(*names, "_lo", "_hi").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_n"))).alias("_a"),
        F.max(F.when(F.col("_side") == 1, F.col("_n"))).alias("_b")).where("_a < _b")
    numbered = line(both).where("_at = 1").select(
        *names, (F.col("_n") - 1).alias("_i"), "_point")
    first = F.floor(F.col("_a") / BLOCK)
    pieces = F.array_repeat(F.lit(0), (F.floor((F.col("_b") - 1) / BLOCK) - first + 1).cast("int"))
    sides = intervals.select(F.struct(*intervals.columns).alias("_interval"), *[
        F.col(c).alias(n) for c, n in zip(i_keys, names)], F.when(usable, start).alias("_lo"),
        F.when(usable, end).alias("_hi"))
    found = _same(sides, numbers, [*names, "_lo", "_hi"], null_safe, "left" if keep == "intervals" else "inner")
    # What matches nothing goes to blocks of its own, so that it does not meet in one task.
    nowhere = -1 - F.pmod(F.xxhash64("_interval"), F.lit(1 << 30))
    blocks = found.select("_interval", *names, "_a", "_b", F.posexplode_outer(pieces).alias("_p", "_z")) \
        .select("_interval", *names, "_a", "_b", F.coalesce(
            F.floor(F.col("_a") / BLOCK) + F.col("_p"), nowhere).alias("_block"))
    unknown = F.lit(False) if null_safe else reduce(
        lambda a, b: a | b, [F.col(n).isNull() for n in names])
    numbered = numbered.withColumn("_block", F.when(
        unknown, -1 - F.pmod(F.xxhash64("_point"), F.lit(1 << 30))).otherwise(
        F.floor(F.col("_i") / BLOCK)))
    inside = (F.col("_i") >= F.col("_a")) & (F.col("_i") < F.col("_b"))
    left, right = (numbered, blocks) if keep == "points" else (blocks, numbered)
    pairs = _same(left, right, [*names, "_block"], null_safe, "left" if keep else "inner", inside)
    out = pairs.select("_interval.*", "_point.*")
    if keep != "points":
        return out
    lost = points.where(F.col(time).isNull())  # not on the line
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields]
    return out.unionByName(lost.select(*none, "*"))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], null_safe: bool, how: str,
          also: Column | None = None) -> DataFrame:
    """Join by columns of the same names, of which the left ones stay."""
    right = right.withColumnsRenamed({n: f"_r{n}" for n in names})
    cond = reduce(lambda a, b: a & b, [
        left[n].eqNullSafe(right[f"_r{n}"]) if null_safe else left[n] == right[f"_r{n}"] for n in names])
    if also is not None:
        cond &= also
    return left.join(right, cond, how).drop(*[f"_r{n}" for n in names])


def match_all(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    lo: str,
    hi: str,
    time: str,
    how: str = "left",
    open_start: bool = False,
) -> DataFrame:
    """Every right row of the key with ``lo <= time < hi`` (``lo < time`` if ``open_start``);
    a left join also keeps left rows without one. See ``all_pairs``."""
    return all_pairs(left, right, on, lo, hi, time, keep="intervals" if how == "left" else None,
                     open_start=open_start)
