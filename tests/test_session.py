"""Stages of a run: registered, released, and found again by a restarted driver."""

import os

import pytest
from pyspark.sql import functions as F

from callweave import session
from callweave.catalog import QUERIES
from callweave.session import delete_path, materialise, path_exists, release, stage_run


def steps(spark, fail=False):
    """Three stages, of which the first two are released."""
    first = materialise(spark.range(10).withColumn("x", F.col("id") * 2), "first")
    second = materialise(first.where("x > 4"), "second")
    release(first)
    if fail:
        raise RuntimeError("lost driver")
    third = materialise(second.groupBy().agg(F.sum("x").alias("s")), "third")
    release(second)
    return third


def folders(run):
    path = run.path.removeprefix("file:")
    return sorted(n for n in os.listdir(path) if n[0] != ".") if os.path.isdir(path) else []


def test_scratch_is_empty_after_a_run(spark):
    with stage_run(spark) as run:
        out = steps(spark)
        assert out.first().s == 6 + 8 + 10 + 12 + 14 + 16 + 18
        assert "0003-third" in folders(run)
    assert not path_exists(spark, run.path)


@pytest.mark.parametrize("name", ["match_last", "job_followup", "job_cascade_match", "dense_number"])
def test_queries_leave_no_stage(spark, name):
    with stage_run(spark) as run:
        QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert folders(run) or name == "match_last"
    assert not path_exists(spark, run.path)


def test_a_failed_run_goes_on_from_its_last_stage(spark):
    made = []
    with pytest.raises(RuntimeError):
        with stage_run(spark, "again") as run:
            steps(spark, fail=True)
    assert folders(run) == ["0001-first.released", "0002-second"]
    kind = type(spark.range(1))
    old = kind.write
    kind.write = property(lambda df: (made.append(1), old.fget(df))[1])
    try:
        with stage_run(spark, "again"):
            assert steps(spark).first().s == 84
    finally:
        kind.write = old
    assert len(made) == 1  # the third stage only
    assert not path_exists(spark, run.path)


def test_a_half_written_stage_is_made_again(spark):
    with pytest.raises(RuntimeError):
        with stage_run(spark, "half") as run:
            first = materialise(spark.range(5), "first")
            delete_path(spark, f"{first.stage_path}/_SUCCESS")
            raise RuntimeError
    with stage_run(spark, "half"):
        assert materialise(spark.range(5), "first").count() == 5
    assert not path_exists(spark, run.path)


def test_the_setting_for_shuffle_files_is_left_as_it_was(spark):
    wide = spark.range(200_000).groupBy(F.xxhash64("id").alias("x")).agg(F.max("id").alias("m"))
    before = spark.conf.get(session.SHUFFLE_CLEANUP)
    assert materialise(wide, "wide").count() == 200_000
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == before
