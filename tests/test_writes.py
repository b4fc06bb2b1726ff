import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from callweave.session import scratch_path
from callweave.sources import sinks
from callweave.sources.sinks import (
    MARKERS, append_slice, newest_day, published, read_slices, replace_slice, upsert,
)
from callweave.sources.tables import covering, high_water_day, read_table, time_slice
from frames import at, frame, rows

SCHEMA = "id int, t timestamp_ntz, v string"


def stored(spark, *data):
    path = scratch_path(spark, "t")
    append_slice(frame(spark, SCHEMA, *data), path, "t")
    return path


OLD = [(1, at("2024-01-01 12:00:00"), "old"), (2, at("2024-01-15 08:00:00"), "old"),
       (3, at("2024-01-15 18:00:00"), "old"), (4, at("2024-01-16 01:00:00"), "old"),
       (5, at("2024-01-17 10:00:00"), "old"), (6, at("2024-01-20 00:00:00"), "old")]


def test_mid_day_window_run_twice(spark):
    path = stored(spark, *OLD)
    new = frame(spark, SCHEMA, (3, at("2024-01-15 18:00:00"), "new"),
                (9, at("2024-01-17 09:00:00"), "new"))
    for _ in range(2):
        replace_slice(new, path, "t", "2024-01-15 12:00:00", "2024-01-17 09:30:00")
        assert rows(read_slices(spark, path), "id", "v") == [
            (1, "old"), (2, "old"), (3, "new"), (5, "old"), (6, "old"), (9, "new")]


def test_empty_slice_only_deletes(spark):
    path = stored(spark, *OLD)
    replace_slice(frame(spark, SCHEMA, *OLD).where("false"), path, "t", "2024-01-15", "2024-01-20")
    assert rows(read_slices(spark, path), "id") == [(1,), (6,)]


def test_first_write_makes_the_table(spark):
    path = scratch_path(spark, "first")
    replace_slice(frame(spark, SCHEMA, *OLD), path, "t", "2024-01-01", "2024-02-01")
    assert read_slices(spark, path).count() == 6


def test_other_days_are_not_touched(spark):
    path = stored(spark, *OLD)
    [kept] = published(spark, path).days["2024-01-01"]
    before = {f: f.stat().st_mtime_ns for f in Path(path.removeprefix("file:")).rglob("*.parquet")
              if "2024-01-01" in str(f)}
    replace_slice(frame(spark, SCHEMA, OLD[4]), path, "t", "2024-01-17", "2024-01-18")
    assert before and all(f.stat().st_mtime_ns == at for f, at in before.items())
    assert published(spark, path).days["2024-01-01"] == [kept]


def test_row_outside_the_window_is_an_error(spark):
    path = stored(spark, *OLD)
    with pytest.raises(PySparkException):
        replace_slice(frame(spark, SCHEMA, OLD[0]), path, "t", "2024-01-15", "2024-01-16")
    assert read_slices(spark, path).count() == 6


def test_upsert_new_row_wins_and_null_keys_never_clash(spark):
    schema = "d date, k string, v int"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = scratch_path(spark, "u")
    upsert(frame(spark, schema, (d1, "a", 1), (d1, None, 2), (d2, "a", 3)), path, ["d", "k"], "d")
    upsert(frame(spark, schema, (d1, "a", 10), (d1, None, 20)), path, ["d", "k"], "d")
    assert rows(read_slices(spark, path), "v") == [(10,), (2,), (20,), (3,)]


def test_half_open_scan_is_pushed_down(spark):
    path = stored(spark, *OLD)
    table = read_slices(spark, path)
    got = time_slice(table, "t", "2024-01-15 08:00:00", "2024-01-17 10:00:00")
    assert rows(got, "id") == [(2,), (3,), (4,)]
    plan = got.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(t" in plan and "v" not in \
        plan.split("ReadSchema:")[1]
    assert high_water_day(table, "t") == dt.date(2024, 1, 20)


def test_named_table(spark):
    frame(spark, SCHEMA, *OLD).createOrReplaceTempView("calls_by_name")
    assert read_table(spark, "calls_by_name").count() == 6


def test_covering_validity(spark):
    df = frame(spark, "id int, s date, e date, x int", (1, dt.date(2024, 1, 1), dt.date(2024, 1, 5), 0),
               (2, dt.date(2024, 1, 2), dt.date(2024, 1, 4), 0))
    got = covering(df, "s", "e", dt.date(2024, 1, 1), dt.date(2024, 1, 5), ["id"])
    assert got.columns == ["id"] and rows(got) == [(1,)]
    assert got.where(F.col("id") == 2).count() == 0


WITH_NOTE = SCHEMA + ", note string"
NOTED = [(*r, f"n{r[0]}") for r in OLD]


def test_kept_rows_keep_columns_that_the_new_rows_lack(spark):
    path = scratch_path(spark, "note")
    append_slice(frame(spark, WITH_NOTE, *NOTED), path, "t")
    replace_slice(frame(spark, SCHEMA, (9, at("2024-01-15 19:00:00"), "new")), path, "t",
                  "2024-01-15 12:00:00", "2024-01-16")
    assert rows(read_slices(spark, path), "id", "note") == sorted(
        [(1, "n1"), (2, "n2"), (4, "n4"), (5, "n5"), (6, "n6"), (9, None)])


@pytest.mark.parametrize("schema, row", [
    (SCHEMA + ", more int", (9, at("2024-01-15 19:00:00"), "new", 1)),
    ("id string, t timestamp_ntz, v string", ("9", at("2024-01-15 19:00:00"), "new"))])
def test_columns_the_table_does_not_have_are_an_error(spark, schema, row):
    path = stored(spark, *OLD)
    with pytest.raises(ValueError):
        replace_slice(frame(spark, schema, row), path, "t", "2024-01-15", "2024-01-16")
    assert read_slices(spark, path).count() == 6


def test_upsert_keeps_columns_and_refuses_two_rows_of_one_key(spark):
    d1 = dt.date(2024, 1, 1)
    path = scratch_path(spark, "u")
    upsert(frame(spark, "d date, k string, v int, note string", (d1, "a", 1, "x"), (d1, "b", 2, "y")),
           path, ["d", "k"], "d")
    upsert(frame(spark, "d date, k string, v int", (d1, "a", 10)), path, ["d", "k"], "d")
    assert rows(read_slices(spark, path), "k", "v", "note") == [("a", 10, None), ("b", 2, "y")]
    with pytest.raises(ValueError):
        upsert(frame(spark, "d date, k string, v int", (d1, "c", 1), (d1, "c", 2)), path, ["d", "k"], "d")
    with pytest.raises(ValueError):
        upsert(frame(spark, "d date, k string, v int", (d1, "c", 1)), path, ["k"], "d")


def test_reads_open_the_days_of_a_window_only(spark):
    path = stored(spark, *OLD)
    got = read_slices(spark, path, "2024-01-15 12:00:00", "2024-01-17")
    assert rows(got, "id") == [(2,), (3,), (4,)]
    assert all("2024-01-15" in f or "2024-01-16" in f for f in got.inputFiles())
    assert newest_day(spark, path) == dt.date(2024, 1, 20)
    assert newest_day(spark, scratch_path(spark, "none")) is None


def test_an_older_day_keeps_a_column_that_the_newest_lacks(spark):
    path = scratch_path(spark, "wide")
    append_slice(frame(spark, WITH_NOTE, *NOTED[:2]), path, "t")
    append_slice(frame(spark, SCHEMA, *OLD[2:]), path, "t")
    assert newest_day(spark, path) == dt.date(2024, 1, 20)
    replace_slice(frame(spark, SCHEMA, (9, at("2024-01-15 19:00:00"), "new")), path, "t",
                  "2024-01-15 12:00:00", "2024-01-16")
    assert (2, "n2") in rows(read_slices(spark, path), "id", "note")


def test_append_checks_types_and_times(spark):
    path = stored(spark, *OLD)
    with pytest.raises(ValueError):
        append_slice(frame(spark, "id string, t timestamp_ntz, v string",
                           ("7", at("2024-01-21"), "new")), path, "t")
    with pytest.raises(PySparkException):
        append_slice(frame(spark, SCHEMA, (7, None, "new")), path, "t")
    append_slice(frame(spark, WITH_NOTE, (7, at("2024-01-15 20:00:00"), "new", "n")), path, "t")
    got = rows(read_slices(spark, path), "id", "note")
    assert len(got) == 7 and (7, "n") in got and (2, None) in got


class Lost(Exception):
    pass


def failing(*_, **__):
    raise Lost


WRITES = {
    "replace": lambda spark, path: replace_slice(
        frame(spark, SCHEMA, (3, at("2024-01-15 18:00:00"), "new")), path, "t",
        "2024-01-15 12:00:00", "2024-01-18"),
    "append": lambda spark, path: append_slice(
        frame(spark, SCHEMA, (7, at("2024-01-15 20:00:00"), "new"), (8, at("2024-02-01"), "new")), path, "t"),
    "upsert": lambda spark, path: upsert(
        frame(spark, SCHEMA + ", d date", (2, at("2024-01-15"), "new", dt.date(2024, 1, 15)),
              (9, at("2024-01-15"), "new", dt.date(2024, 2, 2))), path, ["d", "id"], "d"),
}


@pytest.mark.parametrize("write", sorted(WRITES))
@pytest.mark.parametrize("step", ["_stage", "_publish", "_clear", "staged", "drafted"])
def test_a_lost_write_leaves_the_old_rows_or_all_new_ones(spark, monkeypatch, write, step):
    """The writer is lost at each step: readers see the old table or the whole new one, and the
    next write gives the same as if nothing had happened and clears what was left."""
    schema = SCHEMA + ", d date" if write == "upsert" else SCHEMA
    old = [(*r, r[1].date()) for r in OLD] if write == "upsert" else OLD
    path, sound = scratch_path(spark, "lost"), scratch_path(spark, "sound")
    for p in (path, sound):
        append_slice(frame(spark, schema, *old), p, "t")
    before = rows(read_slices(spark, path))
    WRITES[write](spark, sound)
    after = rows(read_slices(spark, sound))
    with monkeypatch.context() as patch:
        if step == "staged":  # the days are written, but the writer does not learn of it
            real = sinks._stage
            patch.setattr(sinks, "_stage", lambda *a: (real(*a), failing()))
        elif step == "drafted":  # between the draft of the marker and its rename
            patch.setattr(sinks, "path_exists", lambda spark, p: failing() if MARKERS in p else False)
        else:
            patch.setattr(sinks, step, failing)
        with pytest.raises(Lost):
            WRITES[write](spark, path)
    assert rows(read_slices(spark, path)) == (after if step == "_clear" else before)
    if write != "append" or step != "_clear":
        WRITES[write](spark, path)
        assert rows(read_slices(spark, path)) == after
    else:
        append_slice(frame(spark, schema, *old).where("false"), path, "t")
    state = published(spark, path)
    live = {v for n in sinks._numbers(spark, path)
            for vs in sinks._read_marker(spark, path, n).days.values() for v in vs}
    there = {n.split("=")[1] for n in sinks._children(spark, path) if n.startswith("slice_version=")}
    assert there == live and {v for vs in state.days.values() for v in vs} <= there


def test_a_second_writer_is_refused(spark):
    path = stored(spark, *OLD)
    state = published(spark, path)
    append_slice(frame(spark, SCHEMA, (7, at("2024-01-15 20:00:00"), "new")), path, "t")
    with pytest.raises(RuntimeError):
        sinks._publish(spark, path, sinks.Published(state.number + 1, {}, state.schema))
    assert read_slices(spark, path).count() == 7
