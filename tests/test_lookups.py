import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from callweave.operators import lookups
from callweave.operators.identity import content_key, with_stable_id
from callweave.operators.lookups import (
    any_key_member, anti, expand_entities, join_suffix, key_set, left_join_known, scd_lookup, scd_lookup_last, semi,
    winning_pieces,
)
from callweave.operators.metrics import (
    count_check, percent, text_list, text_pieces, unique_check,
)
from callweave.operators.shape import (
    harmonise, layout, stage_checked, stage_typed, union_distinct,
)
from frames import at, frame, rows

FACTS = "id int, k string, d date"
MAP = "mk string, s date, e date, v string"


def day(text):
    return at(text).date()


def data(spark):
    facts = frame(spark, FACTS, (1, "a", day("2024-01-10")), (2, "a", day("2024-01-20")),
                  (3, "b", day("2024-01-10")), (4, None, day("2024-01-10")))
    mapping = frame(spark, MAP, ("a", day("2024-01-01"), day("2024-01-20"), "old"),
                    ("a", day("2024-01-05"), day("2024-01-15"), "mid"),
                    ("a", day("2023-01-01"), day("2023-12-31"), "past"),
                    (None, day("2024-01-01"), day("9999-12-31"), "none"))
    return facts, mapping, [("k", "mk")]


def test_half_open_lookup_fans_out_on_overlap(spark):
    facts, mapping, on = data(spark)
    got = scd_lookup(facts, mapping, on, "d", "s", "e")
    assert rows(got, "id", "v") == sorted(
        [(1, "mid"), (1, "old"), (2, None), (3, None), (4, None)], key=repr)


def test_last_valid_day_needs_the_closed_bound(spark):
    facts, mapping, on = data(spark)
    got = scd_lookup(facts, mapping, on, "d", "s", "e", closed_end=True)
    assert (2, "old") in rows(got, "id", "v")


def test_last_version_wins_and_rows_stay(spark):
    facts, mapping, on = data(spark)
    got = scd_lookup_last(facts, mapping, on, "d", "s", "e", ["v"])
    assert rows(got, "id", "v") == [(1, "mid"), (2, "old"), (3, None), (4, None)]


def test_null_safe_lookup(spark):
    facts, mapping, on = data(spark)
    got = scd_lookup(facts, mapping, on, "d", "s", "e", null_safe=True)
    assert (4, "none") in rows(got, "id", "v")
    got = scd_lookup_last(facts, mapping, on, "d", "s", "e", ["v"], null_safe=True)
    assert (4, "none") in rows(got, "id", "v")


def test_window_does_not_change_the_result(spark):
    facts, mapping, on = data(spark)
    got = scd_lookup(facts, mapping, on, "d", "s", "e", window=(day("2024-01-10"), day("2024-01-20")))
    assert rows(got, "id", "v") == rows(scd_lookup(facts, mapping, on, "d", "s", "e"), "id", "v")


def brute_lookup(facts, versions, closed, safe):
    """{fact id: values of the valid versions, the last of them at the end}"""
    out = {}
    for i, k, t in facts:
        fit = [(s, e, v) for vk, s, e, v in versions if None not in (t, s, e) and s <= t
               and (t <= e if closed else t < e) and (vk == k if safe else k is not None and vk == k)]
        out[i] = [v for *_, v in sorted(fit)]
    return out


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("safe", [False, True])
def test_lookups_against_brute_force(spark, key_size, closed, safe):
    rnd = random.Random(closed * 2 + safe)
    base = dt.date(2024, 1, 1)
    days = lambda n: base + dt.timedelta(days=n)
    versions = [(rnd.choice(["h", "h", "a", None]), days(s := rnd.randrange(40)),
                 rnd.choice([days(s + rnd.randrange(12)), dt.date(9999, 12, 31), None, days(s)]),
                 f"v{i}") for i in range(70)]
    facts = [(i, rnd.choice(["h", "h", "a", "z", None]), rnd.choice([days(rnd.randrange(60)), None]))
             for i in range(120)]
    want = brute_lookup(facts, versions, closed, safe)
    f, m, on = frame(spark, FACTS, *facts), frame(spark, MAP, *versions), [("k", "mk")]
    got = scd_lookup(f, m, on, "d", "s", "e", closed_end=closed, null_safe=safe)
    assert rows(got, "id", "v") == sorted(
        [(i, v) for i, vs in want.items() for v in vs or [None]], key=repr)
    got = scd_lookup_last(f, m, on, "d", "s", "e", ["v"], closed_end=closed, null_safe=safe)
    assert rows(got, "id", "v") == sorted(
        [(i, vs[-1] if vs else None) for i, vs in want.items()], key=repr)


def test_pieces_do_not_overlap(spark):
    _, mapping, _ = data(spark)
    got = winning_pieces(mapping, ["mk"], "s", "e", ["v"])
    a = [r for r in rows(got, "mk", "_from", "_to", "v") if r[0] == "a"]
    assert [r[3] for r in sorted(a, key=lambda r: r[1])] == ["past", "old", "mid", "old"]
    a.sort(key=lambda r: r[1])
    assert all(x[2] <= y[1] for x, y in zip(a, a[1:]))


def test_a_key_of_many_overlapping_versions(spark):
    """100,000 versions of one key, all open at the same time, and 50,000 facts."""
    n = 100_000
    start = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id"))
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    versions = spark.range(n).select(
        F.lit("k").alias("mk"), (base + start).alias("s"),
        F.lit("9999-12-31").cast("timestamp_ntz").alias("e"), F.col("id").alias("v"))
    facts = spark.range(50_000).select("id", F.lit("k").alias("k"), (base + start).alias("d"))
    got = scd_lookup_last(facts, versions, [("k", "mk")], "d", "s", "e", ["v"])
    assert got.where("v = id").count() == 50_000
    early = facts.where("id < 3")
    assert scd_lookup(early, versions, [("k", "mk")], "d", "s", "e").count() == 1 + 2 + 3


def test_anti_join_survives_null_keys(spark):
    facts, _, _ = data(spark)
    keys = frame(spark, "x string", ("a",), (None,))
    assert rows(anti(facts, keys, [("k", "x")]), "id") == [(3,), (4,)]
    assert rows(semi(facts, keys, [("k", "x")]), "id") == [(1,), (2,)]


def test_any_key_member(spark):
    people = frame(spark, "id int, c string, p1 string, p2 string", (1, "c1", None, None),
                   (2, "cx", "5551234567", None), (3, "cx", None, "555"), (4, None, None, None))
    phones = frame(spark, "p string", ("5551234567",), ("555",))
    contracts = frame(spark, "c string", ("c1",), ("555",))
    long = lambda c: F.when(F.length(c) > 9, F.col(c))
    got = any_key_member(people, ["id"], [("c", [F.col("c")]), ("p", [long("p1"), long("p2")])],
                         {"c": contracts, "p": phones})
    assert rows(got, "id") == [(1,), (2,)]


def test_entities_bring_their_other_members(spark):
    pairs = frame(spark, "person string, c string", ("p", "1"), ("p", "2"), ("q", "3"), (None, "1"))
    active = frame(spark, "a string", ("1",))
    assert rows(expand_entities(pairs, "person", "c", active)) == [("p", "1"), ("p", "2")]


def test_clashing_names_get_a_suffix(spark):
    facts, _, _ = data(spark)
    right = frame(spark, "k string, id int", ("a", 9))
    got = join_suffix(facts, right, [("k", "k")])
    assert got.columns == ["id", "k", "d", "id_y"]


def test_key_set(spark):
    facts, mapping, _ = data(spark)
    assert rows(key_set((facts, "k"), (mapping, "mk"))) == [("a",), ("b",)]


def test_stable_ids_are_unique_and_repeat(spark):
    df = frame(spark, "a string, b int", *[("x", 1)] * 7, ("x", None), ("", 1), (None, 1))
    for copies in (1_000_000, 2):
        ids = [r[0] for r in with_stable_id(df, "rid", copies_per_task=copies).collect()]
        again = [r[0] for r in with_stable_id(df.repartition(3), "rid", copies).collect()]
        assert len(set(ids)) == 10 and sorted(ids) == sorted(again)


def test_content_key_keeps_borders(spark):
    df = frame(spark, "a string, b string", ("ab", "c"), ("a", "bc"), (None, "x"), ("", "x"))
    assert df.select(content_key(["a", "b"])).distinct().count() == 4


def test_checks(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 2), (None, 3))
    assert rows(unique_check(df, {"a": "a", "b": "b"})) == [("a", 2, 1, 0), ("b", 3, 3, 1)]
    assert rows(count_check("n", df, df.where("b > 1"))) == [("n", 3, 2, 0)]


def test_zero_denominator_is_null(spark):
    df = frame(spark, "a int, b int", (1, 0), (1, 4))
    assert [r[0] for r in df.select(percent("a", "b")).collect()] == [None, 25.0]


def test_unique_check_is_one_pass(spark):
    """Nulls, values in several tasks, no row at all; nothing is expanded."""
    df = spark.range(0, 5000, 1, 7).selectExpr(
        "id a", "id % 4999 b", "if(id > 5, 'x', concat('u', id)) c", "cast(null as int) d")
    got = unique_check(df, dict(zip("abcd", "abcd")))
    assert rows(got) == [("a", 5000, 5000, 1), ("b", 5000, 4999, 0), ("c", 5000, 7, 0), ("d", 0, 0, 1)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(unique_check(df.where("false"), {"a": "a"})) == [("a", 0, 0, 1)]


def test_pieces_of_a_list_make_up_the_list(spark, key_size):
    rnd = random.Random(6)
    data = [(rnd.choice(["g", "g", "h", None]), i, rnd.choice([None, "", "value", "éé" * 9]))
            for i in range(200)]
    df = frame(spark, "k string, o int, v string", *data)
    whole = df.groupBy("k").agg(text_list(F.col("v"), [F.col("o")]).alias("t"))
    pieces = text_pieces(df, ["k"], F.col("v"), ["o"], size=30).orderBy("k", "piece").collect()
    joined = {}
    for r in pieces:
        assert r.offset == len(joined.get(r.k, "")) and len(r.text) <= 30 + 18 + 1
        joined[r.k] = joined.get(r.k, "") + r.text
    assert joined == {r.k: r.t for r in whole.collect()}


def test_staging_with_quarantine(spark):
    schema = layout("n int, d date, s string")
    raw = frame(spark, "a string, b string, c string", ("1", "2024-01-01", "x"), ("one", "2024-13-01", "y"),
                (None, None, None), ("5000000000", "2024-01-02", "z"))
    got = stage_checked(raw, schema, by_position=True)
    assert rows(got.good, "n", "s") == sorted([(1, "x"), (None, None)], key=repr)
    assert rows(got.bad, "column", "text", "reason") == [
        ("d", "2024-13-01", "not a value of type date"), ("n", "5000000000", "out of range of int"),
        ("n", "one", "not a value of type int")]
    assert rows(got.counts) == [(4, 2, 2, 3, 1)]
    for load in (stage_checked, stage_typed):
        with pytest.raises(ValueError):
            load(raw.drop("c"), schema, by_position=True)
    assert rows(stage_checked(raw.where("false"), schema, by_position=True).counts) == [(0, 0, 0, 0, 1)]


def test_text_list_prints_missing_values(spark):
    df = frame(spark, "o int, v string", (2, None), (1, "x"), (3, "y"))
    assert df.agg(text_list(F.col("v"), [F.col("o")])).first()[0] == "x,NA,y"


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("safe", [False, True])
@pytest.mark.parametrize("few", [0, lookups.FEW_VERSIONS])
def test_few_versions_and_the_sweep_agree(spark, monkeypatch, few, closed, safe):
    monkeypatch.setattr(lookups, "FEW_VERSIONS", few)
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    days = lambda n: base + dt.timedelta(days=n)
    versions = [(rnd.choice(["h", "a", None]), days(s := rnd.randrange(30)),
                 rnd.choice([days(s + rnd.randrange(9)), None, days(s)]), f"v{i % 9}") for i in range(40)]
    facts = [(i // 2, rnd.choice(["h", "a", "z", None]), rnd.choice([days(rnd.randrange(40)), None]))
             for i in range(60)]
    f, m, on = frame(spark, FACTS, *facts), frame(spark, MAP, *versions), [("k", "mk")]
    want = [(i, v) for i, k, t in facts
            for v in brute_lookup([(i, k, t)], versions, closed, safe)[i] or [None]]
    got = scd_lookup(f, m, on, "d", "s", "e", closed_end=closed, null_safe=safe)
    assert rows(got, "id", "v") == sorted(want, key=repr)
    last = [(i, (brute_lookup([(i, k, t)], versions, closed, safe)[i] or [None])[-1]) for i, k, t in facts]
    got = scd_lookup_last(f, m, on, "d", "s", "e", ["v"], closed_end=closed, null_safe=safe)
    assert rows(got, "id", "v") == sorted(last, key=repr)


def test_few_versions_do_not_move_the_facts(spark):
    mapping = frame(spark, "mk long, s timestamp_ntz, e timestamp_ntz, v string",
                    (1, at("2024-01-01"), at("2024-02-01"), "x"))
    facts = spark.range(50_000).selectExpr("id", "id % 5 AS k", "TIMESTAMP_NTZ'2024-01-05' AS at")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = scd_lookup(facts, mapping, [("k", "mk")], "at", "s", "e")
    assert "SortMergeJoin" not in plan(found) and "Exchange hashpartitioning" not in plan(found)
    last = scd_lookup_last(facts, mapping, [("k", "mk")], "at", "s", "e", ["v"])
    assert "Window" not in plan(last)  # no time line with the facts
    assert found.where("v = 'x'").count() == last.where("v = 'x'").count() == 10_000


def test_many_versions_of_a_key_are_swept(spark):
    mapping = frame(spark, MAP, *[("a", day("2024-01-01"), day("2024-01-02"), f"v{i}")
                                  for i in range(lookups.FEW_OF_A_KEY + 1)])
    assert lookups._few(mapping.limit(lookups.FEW_OF_A_KEY), ["mk"]) and not lookups._few(mapping, ["mk"])


def test_filler_does_not_move_with_the_rows_made_distinct(spark):
    target = layout("tag string, a bigint, b string, n int")
    side = lambda tag, **more: harmonise(
        spark.range(6), target, {"tag": F.lit(tag), "a": F.col("id") % 3, **more}, distinct=True)
    got = union_distinct(side("x"), side("y", b=(F.col("id") % 3).cast("string")), apart=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "NA" not in "".join(
        line for line in plan.splitlines() if "HashAggregate" in line)
    assert rows(got) == sorted(
        [(t, a, "NA" if t == "x" else str(a), None) for t in "xy" for a in range(3)], key=repr)


def test_join_by_a_text_reads_the_left_table_once(spark):
    left = spark.range(1_000).selectExpr("id", "if(id % 2 = 0, null, cast(id % 10 as string)) k")
    right = frame(spark, "r string, v int", ("1", 1), ("1", 2), ("3", 3), (None, 4))
    got = left_join_known(left, right.hint("merge"), [("k", "r")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Range (") == 1
    assert got.where("v IS NOT NULL").count() == 300 and got.count() == 1_100
    assert got.where("k IS NULL AND r IS NULL AND v IS NULL").count() == 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = got.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) == 2 and min(r["count"] for r in spread) > 100
    numbers = left_join_known(left.selectExpr("id", "int(k) k"), right.selectExpr("int(r) r", "v"), [("k", "r")])
    assert rows(numbers.selectExpr("id", "v")) == rows(got.selectExpr("id", "v"))
