import random

from pyspark.sql import functions as F

from callweave.operators import ordered
from callweave.operators.ordered import (
    KeyLine, first_per_group, keep_best, tasks_for, with_group_max, with_next, with_next_or_max,
    with_row_number,
)
from callweave.operators.skew import HOT_ROWS, MOST_RANGES, find_hot, hot_limit, range_count
from frames import at, frame, rows

SCHEMA = "k string, t timestamp_ntz, id int, v int"


def sample(spark, seed=1, n=200):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = rnd.choice(["hot", "hot", "hot", "a", "b", None])
        second = rnd.randrange(120)
        data.append((key, at(f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}"), i,
                     rnd.choice([None, rnd.randrange(100)])))
    return frame(spark, SCHEMA, *data), data


def by_key(data):
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    return {k: sorted(g, key=lambda r: (r[1], r[2])) for k, g in groups.items()}


def test_next_row(spark, key_size):
    df, data = sample(spark)
    want = []
    for key, group in by_key(data).items():
        for i, r in enumerate(group):
            nxt = group[i + 1] if key is not None and i + 1 < len(group) else (None,) * 4
            want.append((r[2], nxt[1], nxt[2]))
    hot = find_hot(df, ["k"])
    assert (hot is None) == (key_size == "whole")
    got = with_next(df, ["k"], ["t", "id"], {"nt": "t", "ni": "id"}, hot=hot, null_keys="never")
    assert rows(got, "id", "nt", "ni") == sorted(want, key=repr)


def test_null_key_as_a_group(spark, key_size):
    df, data = sample(spark, seed=2)
    want = []
    for group in by_key(data).values():
        for i, r in enumerate(group):
            want.append((r[2], group[i + 1][2] if i + 1 < len(group) else None))
    got = with_next(df, ["k"], ["t", "id"], {"ni": "id"}, hot=find_hot(df, ["k"]))
    assert rows(got, "id", "ni") == sorted(want, key=repr)


def test_row_numbers(spark, key_size):
    df, data = sample(spark, seed=3)
    for backwards in (False, True):
        want = []
        for group in by_key(data).values():
            group = group[::-1] if backwards else group
            want += [(r[2], i + 1) for i, r in enumerate(group)]
        got = with_row_number(df, ["k"], ["t", "id"], backwards=backwards,
                              hot=find_hot(df, ["k"]))
        assert rows(got, "id", "rn") == sorted(want, key=repr)


def test_running_values_both_ways(spark, key_size):
    df, data = sample(spark, seed=4)
    want = []
    for group in by_key(data).values():
        for i, r in enumerate(group):
            before = [x[3] for x in group[:i] if x[3] is not None]
            upto = [x[3] for x in group[:i + 1] if x[3] is not None]
            after = [x[3] for x in group[i:] if x[3] is not None]
            want.append((r[2], before[-1] if before else None, max(upto, default=None),
                         len(upto), after[0] if after else None))
    line = KeyLine(df, ["k"], ["t", "id"], hot=find_hot(df, ["k"]))
    line.run(last={"prev": F.col("v")}, include_current=False)
    line.run(largest={"top": F.col("v")}, counts={"n": F.col("v")})
    line.run(last={"nxt": F.col("v")}, backwards=True)
    assert rows(line.rows(), "id", "prev", "top", "n", "nxt") == sorted(want, key=repr)


def test_next_or_group_maximum(spark, key_size):
    df, data = sample(spark, seed=5)
    df = df.withColumn("end", F.col("t") + F.expr("make_dt_interval(0, 0, 0, v)"))
    ends = {r["id"]: r["end"] for r in df.collect()}
    want = []
    for group in by_key(data).values():
        top = max((ends[r[2]] for r in group if ends[r[2]] is not None), default=None)
        for i, r in enumerate(group):
            last = i + 1 == len(group)
            plus = None if top is None else top + (at("2024-01-01 00:05:00") - at("2024-01-01"))
            want.append((r[2], plus if last else group[i + 1][1]))
    got = with_next_or_max(df, ["k"], ["t", "id"], "t", "end", "INTERVAL '5' MINUTE", "n",
                           hot=find_hot(df, ["k"]))
    assert rows(got, "id", "n") == sorted(want, key=repr)


def test_group_max_matches_null_keys(spark):
    df = frame(spark, SCHEMA, ("a", None, 1, 5), ("a", None, 2, 9), (None, None, 3, 4))
    assert rows(with_group_max(df, ["k"], "v", "top"), "id", "top") == [(1, 9), (2, 9), (3, 4)]


def test_first_per_group_is_limited_before_the_shuffle(spark):
    df, _ = sample(spark)
    got = first_per_group(df, ["k"], [F.asc("t"), F.asc("id")])
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_keep_best_keeps_every_row_without_id(spark):
    df = frame(spark, SCHEMA, ("a", None, 1, 5), ("a", None, 2, 9), (None, None, 3, 4),
               (None, None, 3, 4))
    got = keep_best(df, "k", [F.desc("v"), F.asc("id")])
    assert rows(got, "id") == [(2,), (3,), (3,)]


def test_one_key_in_one_second_is_spread_evenly(spark):
    """A million rows that only their id tells apart: no task has twice the mean."""
    n = 1_000_000
    df = spark.range(n).selectExpr("'k' k", "timestamp_ntz'2024-01-01' t", "id", "id % 7 v")
    with hot_limit(spark, 250_000):
        hot = find_hot(df, ["k"])
        assert hot.ranges == 8
        line = KeyLine(df, ["k"], ["t", "id"], hot=hot).run(
            last={"before": F.col("id")}, counts={"rn": F.lit(1)}, include_current=False)
        got = line.rows()
        sizes = [r["count"] for r in hot.split(df, ["t", "id"])[1].groupBy(
            F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    assert got.where("rn = id AND (before = id - 1 OR id = 0)").count() == n


def test_ranges_are_chosen_once_and_not_dealt_again(spark):
    """The window and the summaries of the ranges must agree on the ranges."""
    n = 60_000
    df = spark.range(0, n, 1, 8).selectExpr("id % 3 k", "timestamp_ntz'2024-01-01' t", "id")
    with hot_limit(spark, 2_000):
        got = with_next(df, ["k"], ["t", "id"], {"ni": "id"}, hot=find_hot(df, ["k"]), null_keys="never")
    assert got.where("ni = id + 3").count() == n - 3 and got.where("ni IS NULL").count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_ranges_do_not_grow_with_the_rows_of_a_low_limit(spark):
    """Each range is a task of every stage: 36 million rows above a limit of three were 36,000."""
    assert range_count(36_000_000, 3) == MOST_RANGES
    assert range_count(5_000, 3) == 6  # small tables are cut as before
    rows = 4 * MOST_RANGES * HOT_ROWS  # and no range outgrows the usual limit
    assert rows / range_count(rows, 3) <= HOT_ROWS
    assert range_count(rows, HOT_ROWS) == 8 * MOST_RANGES
    df = spark.range(600_000).selectExpr("id % 1000 AS k", "id")
    hot = find_hot(df, ["k"], max_rows=3)
    assert hot.ranges == MOST_RANGES
    numbered = with_row_number(df, ["k"], ["id"], hot=hot)
    assert numbered.where("rn <> id div 1000 + 1").isEmpty() and numbered.count() == 600_000


def test_next_or_max_needs_one_sort(spark):
    df = spark.range(100).selectExpr("id % 3 k", "timestamp_ntz'2024-01-01' t", "id")
    got = with_next_or_max(df, ["k"], ["t", "id"], "t", "t", "INTERVAL '5' MINUTE", "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_tasks_of_a_line_follow_its_rows(spark, monkeypatch):
    """Rows of a task do not grow with the table; a missing key is not dealt to one of them."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    df = spark.range(2_000).selectExpr("if(id % 4 = 0, null, id) k", "id")
    assert tasks_for(df) == 20 and tasks_for(df.limit(100)) is None
    line = KeyLine(df, ["k"], ["id"], null_keys="never", tasks=tasks_for(df))
    got = line.run(counts={"n": F.lit(1)}).rows()
    parts = got.where("k IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 200
    assert got.where("n = 1").count() == 1_500 and got.where("k IS NULL AND n = 0").count() == 500
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and plan.count("Exchange") == 1
