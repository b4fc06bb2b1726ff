"""Attribute confirmed call backs to the predictive call they follow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from callweave.functions.dates import first_of_next_month, midnight, seconds_between
from callweave.functions.nulls import greatest_strict, is_true
from callweave.functions.tags import flag
from callweave.functions.text import like, text_equal
from callweave.operators.ordered import KeyLine, tasks_for
from callweave.operators.skew import find_hot
from callweave.plans.fixed_values import CALL_COLUMNS, CALLBACK_COLUMNS, FOLLOWUP_COLUMNS
from callweave.plans.params import DialerParams, RunWindow, _moment
from callweave.session import materialise, path_exists
from callweave.sources.tables import time_slice

KEY = ["CB_key"]
ORDER = ["dt_chamada", "_kind", "id_call_ayty"]
CARRIED = [*CALL_COLUMNS, "Is_Sale", "CB_key"]


def classify(calls: DataFrame, params: DialerParams) -> DataFrame:
    """Sale flag, customer-agent key and call kind; a missing call type is neither kind."""
    is_callback = text_equal(F.col("tipo_de_ligao"), params.callback_type, params.ignore_case)
    return calls.select(
        *CALL_COLUMNS,
        flag(like(F.col("status"), params.sale_status, params.ignore_case)).alias("Is_Sale"),
        F.concat("telefone", F.lit("_"), "login_telefonia").alias("CB_key"),
        # A call back sorts before a predictive call of the same second: it only
        # follows calls strictly before it.
        F.when(is_callback, 0).when(~is_callback, 1).alias("_kind"),
    ).where(F.col("_kind").isNotNull())


def followup(calls: DataFrame, params: DialerParams) -> DataFrame:
    """Dialer calls of the window with the confirmed call back inside their gap.

    The gap of a predictive call ends at the next predictive call of its key, or at the end
    of its month. One pass over each key in time order gives every row its next predictive
    call, its next sale call back and the predictive call before it. A call back inside a gap
    belongs to exactly one call, so the range join needs no pairs.
    """
    base = classify(time_slice(calls, "dt_chamada", params.window.start, params.window.end),
                    params).withColumn("_answered", F.lit(False))
    return _attributed(_line(base), base.schema, F.lit(True))


class FollowupDay(NamedTuple):
    """``rows`` are final; ``waiting`` holds the calls whose gap is still open at the window's
    end, for the run of the next window."""

    rows: DataFrame
    waiting: DataFrame


def followup_day(
    calls: DataFrame, waiting: DataFrame | None, params: DialerParams
) -> FollowupDay:
    """``followup`` in consecutive windows: together they give the rows of one long window.

    ``waiting`` is what the run of the window before left over, at most one call for each key. A
    call without a confirmed call back is only given out when its gap has ended, by the next call
    of its key or with its month; a call back is given out at once, with the call it follows,
    which may be a waiting one.
    """
    base = classify(time_slice(calls, "dt_chamada", params.window.start, params.window.end),
                    params).withColumns({"_answered": F.lit(False), "_waited": F.lit(False)})
    if waiting is not None:
        base = base.unionByName(waiting.withColumn("_waited", F.lit(True)))
    line = materialise(_line(base), "followup-line")
    month_over = first_of_next_month(F.to_date("dt_chamada")) <= F.lit(
        str(params.window.end)).cast("timestamp_ntz")
    ended = F.col("CB_key").isNull() | F.col("_next_call").isNotNull() | month_over
    kept = base.drop("_waited").schema
    rows = _attributed(line, kept, ended)
    open_ = line.where((F.col("_kind") == 1) & ~ended)
    return FollowupDay(rows, open_.withColumn(
        "_answered", F.col("_answered") | is_true(F.col("_next_back") < _gap_end()))
        .select(*kept.fieldNames()))


def run_days(
    calls: DataFrame, store: str, params: DialerParams, cuts: Sequence = (),
) -> list[DataFrame]:
    """The rows of the window, as runs of the parts between ``cuts`` (its days by default) give
    them. Each part reads the waiting calls that the part before it stored in the folder
    ``store`` and stores its own under its end, so that a part can be run again and a later
    process goes on from the newest one."""
    spark = calls.sparkSession
    start, end = params.window.start, params.window.end
    days = (end.date() - start.date()).days
    inner = [_moment(c) for c in cuts] or [_moment(start.date() + dt.timedelta(days=n + 1))
                                           for n in range(days)]
    ends = [*[c for c in inner if start < c < end], end]
    out = []
    for lo, hi in zip([start, *ends], ends):
        part = replace(params, window=RunWindow(lo, hi))
        before = f"{store}/until={lo:%Y%m%dT%H%M%S}"
        waiting = spark.read.parquet(before) if path_exists(spark, before) else None
        day = followup_day(calls, waiting, part)
        day.waiting.write.mode("overwrite").parquet(f"{store}/until={hi:%Y%m%dT%H%M%S}")
        out.append(day.rows)
    return out


def _gap_end() -> Column:
    from_time = F.when(F.col("_kind") == 1, F.col("dt_chamada")).otherwise(
        F.col("_before.dt_chamada"))
    return F.when(F.col("CB_key").isNotNull(), F.coalesce(
        "_next_call", midnight(first_of_next_month(F.to_date(from_time)))))


def _line(base: DataFrame) -> DataFrame:
    """Every row with the next predictive call of its key, the next sale call back and the
    predictive call before it."""
    hot = find_hot(base.where(F.col("CB_key").isNotNull()), KEY)
    line = KeyLine(base, KEY, ORDER, hot=hot, null_keys="never", tasks=tasks_for(base))
    predictive = F.col("_kind") == 1
    sale_back = (F.col("_kind") == 0) & (F.col("Is_Sale") == 1)
    line.run(backwards=True, include_current=False, last={
        "_next_call": F.when(predictive, F.col("dt_chamada")),
        "_next_back": F.when(sale_back, F.col("dt_chamada")),
    })
    line.run(include_current=False, last={"_before": F.when(predictive, F.struct(*CARRIED))})
    return line.rows()


def _attributed(line: DataFrame, kinds: StructType, ended: Column) -> DataFrame:
    """Rows of the result; a call is given out alone once its gap has ``ended``."""
    predictive = F.col("_kind") == 1
    sale_back = (F.col("_kind") == 0) & (F.col("Is_Sale") == 1)
    answered = F.col("_answered") | is_true(F.col("_next_back") < _gap_end())
    in_gap = sale_back & F.col("_before").isNotNull() & (F.col("dt_chamada") < _gap_end())

    no_back = {c: F.lit(None).cast(kinds[src].dataType) for c, src in CALLBACK_COLUMNS.items()}
    no_gap = F.lit(None).cast("bigint")
    own = {c: F.col(c) for c in CARRIED}
    before = {c: F.col(f"_before.{c}") for c in CARRIED}

    def row(call, sale_final, gap, back):
        cols = {**call, "is_Sale_final": sale_final, "time_difference": gap, **back}
        return F.struct(*[cols[c].alias(c) for c in FOLLOWUP_COLUMNS])

    # Predictive rows carry their load time as update time, call back rows their own.
    lone = row({**own, "UpdateDate": F.col("LoadDate")}, F.col("Is_Sale"), no_gap, no_back)
    followed = row(
        {**before, "UpdateDate": F.col("_before.LoadDate")},
        greatest_strict(F.col("_before.Is_Sale"), F.coalesce("Is_Sale", F.lit(0))),
        seconds_between(F.col("_before.dt_chamada"), F.col("dt_chamada")),
        {c: F.col(src) for c, src in CALLBACK_COLUMNS.items()},
    )
    back_row = row(own, F.col("Is_Sale"), no_gap, no_back)
    rows = F.array_compact(F.array(
        F.when(predictive & ~answered & ended, lone),
        F.when(in_gap, followed),
        F.when(~predictive, back_row),
    ))
    return line.select(F.inline(rows)).select(*FOLLOWUP_COLUMNS).distinct()
