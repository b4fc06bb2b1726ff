import datetime as dt

from pyspark.sql import functions as F

from callweave.functions import dates, nulls, tags, text
from frames import at, frame


def one(spark, column, schema="x int", row=(1,)):
    return frame(spark, schema, row).select(column.alias("v")).first()["v"]


def test_greatest_and_least_need_every_value(spark):
    two = lambda f: one(spark, f(F.col("a"), F.col("b")), "a int, b int", (1, None))
    assert two(nulls.greatest_strict) is None and two(nulls.least_strict) is None
    assert one(spark, nulls.greatest_strict(F.col("a"), F.col("b")), "a int, b int", (1, 3)) == 3


def test_pad_never_shortens(spark):
    pad = lambda v: one(spark, text.pad_left(F.col("x"), 3), "x string", (v,))
    assert [pad("7"), pad("123"), pad("12345"), pad(None)] == ["007", "123", "12345", None]


def test_no_match_is_null(spark):
    hit = lambda v: one(spark, text.first_match(F.col("x"), r"^co\d{1,2}"), "x string", (v,))
    assert [hit("co4 x"), hit("co123"), hit("x co4"), hit(None)] == ["co4", "co12", None, None]


def test_alnum_run_takes_letters_of_any_script(spark):
    run = lambda v: one(spark, text.first_alnum(F.col("x")), "x string", (v,))
    assert [run("--éa9 b"), run("***")] == ["éa9", None]


def test_contract_key_and_status(spark):
    def both(v):
        key = text.contract_key(F.col("x"))
        return one(spark, F.struct(key.alias("k"), text.key_status(key).alias("s")),
                   "x string", (v,))

    assert tuple(both(" '12345678901299 ")) == ("123456789012", "valid")
    assert tuple(both("0000")) == ("0000", "zero")
    assert tuple(both("   ")) == ("", "blank")
    assert tuple(both(None)) == (None, "valid")


def test_like_case_is_an_option(spark):
    row = ("x string", ("Venda CONFIRMADA",))
    assert one(spark, text.like(F.col("x"), "%confirmada%"), *row) is False
    assert one(spark, text.like(F.col("x"), "%confirmada%", ci=True), *row) is True
    assert one(spark, text.text_equal(F.col("x"), "venda confirmada", ci=True), *row) is True


def test_paste_prints_missing_parts(spark):
    pasted = nulls.paste(F.col("a"), F.lit("_"), F.col("b"))
    assert one(spark, pasted, "a string, b string", (None, "x")) == "NA_x"


def test_unknown_condition_gives_null(spark):
    assert one(spark, nulls.if_else(F.col("x") == 1, "y", "n"), "x int", (None,)) is None


def test_conditional_delete_keeps_unknown(spark):
    df = frame(spark, "x string", ("down",), ("up",), (None,))
    kept = {r[0] for r in df.where(nulls.keep_unless(F.col("x").like("%down%"))).collect()}
    assert kept == {"up", None}


def test_ceil_day_leaves_midnight(spark):
    up = lambda v: one(spark, dates.ceil_day(F.col("x")), "x timestamp_ntz", (at(v),))
    assert up("2024-01-31 00:00:00") == at("2024-01-31 00:00:00")
    assert up("2024-01-31 00:00:01") == at("2024-02-01 00:00:00")


def test_seconds_between_is_whole_and_signed(spark):
    gap = lambda a, b: one(spark, dates.seconds_between(F.col("a"), F.col("b")),
                           "a timestamp_ntz, b timestamp_ntz", (at(a), at(b)))
    assert gap("2024-01-01 00:00:00.5", "2024-01-01 00:00:02") == 1
    assert gap("2024-01-01 00:00:02", "2024-01-01 00:00:00.5") == -1
    assert gap("2024-01-01", "2024-03-01") == 60 * 86400  # more than 838 hours


def test_epoch_seconds_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = one(spark, dates.epoch_seconds(F.col("x")), "x timestamp_ntz",
                  (at("1970-01-02 00:01:00"),))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == 86460


def test_bad_dates_are_null(spark):
    assert one(spark, dates.parse_day(F.col("x")), "x string", ("nope",)) is None
    assert one(spark, dates.parse_day(F.col("x")), "x string", ("2024-02-03",)) == dt.date(2024, 2, 3)
    assert one(spark, dates.parse_timestamp(F.col("x")), "x string", ("nope",)) is None


def test_tags(spark):
    tag = tags.tag_by_list(F.col("x"), {"a": [1, 2], "b": [2, 3]})
    got = [one(spark, tag, "x int", (v,)) for v in (1, 2, 3, 4, None)]
    assert got == ["a", "a", "b", "other", "other"]
    rank = tags.rank_by_levels(F.col("x"), ["home", "mobile"])
    assert [one(spark, rank, "x string", (v,)) for v in ("mobile", "home", "fax", None)] == [2, 1, 3, 3]
