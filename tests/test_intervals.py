import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from callweave.operators import intervals
from callweave.operators.intervals import match_all, match_last
from frames import at, frame, rows

CALLS = "cid int, ck string, cc string, lo timestamp_ntz, hi timestamp_ntz"
OUTS = "oid int, ok string, oc string, t timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def sec(n):
    return None if n is None else T0 + dt.timedelta(seconds=n)


def last(spark, calls, outs, **kw):
    got = match_last(frame(spark, CALLS, *calls), frame(spark, OUTS, *outs), [("ck", "ok")],
                     "lo", "hi", "t", "oid", **kw)
    return rows(got, "cid", "oid")


def test_bounds(spark):
    call = (1, "a", "x", sec(10), sec(20))
    assert last(spark, [call], [(1, "a", "x", sec(10))]) == [(1, 1)]
    assert last(spark, [call], [(1, "a", "x", sec(20))]) == [(1, None)]
    assert last(spark, [call], [(1, "a", "x", sec(9))]) == [(1, None)]


def test_missing_keys_and_ends_never_match(spark):
    calls = [(1, None, "x", sec(0), sec(9)), (2, "a", "x", sec(0), None), (3, "a", "x", None, sec(9)),
             (4, "a", "x", sec(5), sec(5))]
    outs = [(1, None, "x", sec(5)), (2, "a", "x", None), (3, "a", "x", sec(5))]
    assert last(spark, calls, outs) == [(1, None), (2, None), (3, None), (4, None)]


@pytest.mark.parametrize("differ", [None, ("cc", "oc")])
def test_against_brute_force(spark, key_size, differ):
    rnd = random.Random(7)
    calls, outs = [], []
    for i in range(150):
        lo = rnd.randrange(300)
        calls.append((i, rnd.choice(["h", "h", "a", None]), rnd.choice(["x", "y", None]), sec(lo),
                      sec(lo + rnd.randrange(40))))
    for i in range(150):
        outs.append((i, rnd.choice(["h", "h", "a", None]), rnd.choice(["x", "y"]),
                     sec(rnd.randrange(340))))
    want = []
    for c in calls:
        fit = [o for o in outs if c[1] is not None and o[1] == c[1] and c[3] <= o[3] < c[4]
               and (differ is None or (c[2] is not None and o[2] != c[2]))]
        want.append((c[0], max(fit, key=lambda o: (o[3], o[0]))[0] if fit else None))
    assert last(spark, calls, outs, differ=differ) == sorted(want, key=repr)


@pytest.mark.parametrize("open_start", [False, True])
def test_all_matches_against_brute_force(spark, key_size, open_start, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK", 4)
    rnd = random.Random(8)
    calls = [(i, rnd.choice(["a", "b", None]), "x", sec(lo := rnd.randrange(300)),
              sec(lo + rnd.randrange(90))) for i in range(80)]
    outs = [(i, rnd.choice(["a", "b", None]), "x", sec(rnd.randrange(340))) for i in range(80)]
    want = []
    for c in calls:
        fit = [o[0] for o in outs if c[1] is not None and o[1] == c[1]
               and (c[3] < o[3] if open_start else c[3] <= o[3]) and o[3] < c[4]]
        want += [(c[0], o) for o in fit] or [(c[0], None)]
    got = match_all(frame(spark, CALLS, *calls), frame(spark, OUTS, *outs), [("ck", "ok")], "lo",
                    "hi", "t", open_start=open_start)
    assert rows(got, "cid", "oid") == sorted(want, key=repr)
    assert at("2024-01-01") == T0


def test_open_ends_long_intervals_and_a_dense_second(spark):
    """An open end among short intervals, and 20,000 outcomes of one second."""
    calls = frame(spark, CALLS, (1, "a", "x", sec(0), dt.datetime(9999, 12, 31)),
                  (2, "a", "x", sec(5), sec(6)), (3, "a", "x", sec(7), sec(8)),
                  (4, "b", "x", sec(0), sec(9)), (5, "a", "x", sec(6), sec(6)))
    outs = spark.range(20_000).selectExpr("cast(id as int) oid", "'a' ok", "'x' oc",
                                          "timestamp_ntz'2024-01-01 00:00:05' t")
    got = match_all(calls, outs, [("ck", "ok")], "lo", "hi", "t")
    assert rows(got.groupBy("cid").agg(F.count("oid").alias("n")), "cid", "n") == [
        (1, 20_000), (2, 20_000), (3, 0), (4, 0), (5, 0)]
    assert match_all(calls, outs, [("ck", "ok")], "lo", "hi", "t", how="inner").count() == 40_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "sequence(" not in plan and "NestedLoop" not in plan


def test_missing_value_differs_from_nothing(spark, key_size):
    left = frame(spark, "k string, a timestamp_ntz, b timestamp_ntz, c string",
                 ("k", at("2024-01-01 10:00:00"), at("2024-01-01 12:00:00"), "B"))
    right = frame(spark, "rk string, t timestamp_ntz, rc string, rid int",
                  ("k", at("2024-01-01 10:30:00"), "A", 1), ("k", at("2024-01-01 11:00:00"), None, 2))
    got = match_last(left, right, [("k", "rk")], "a", "b", "t", "rid", differ=("c", "rc"))
    assert rows(got, "rid") == [(1,)]
