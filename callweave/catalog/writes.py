"""Writes to a new folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.catalog.registry import Tables, query
from callweave.operators.shape import layout, stage_checked, stage_typed
from callweave.plans.params import RunWindow
from callweave.plans.sensors import SENSOR_KEY
from callweave.session import scratch_path
from callweave.sources.sinks import append_slice, newest_day, read_slices, replace_slice, upsert
from callweave.sources.tables import time_slice


@query("""
SELECT CAST(event_id AS INTEGER) AS id, TRY_CAST(event_type AS INTEGER) AS type_code,
       CAST(floor(value) AS INTEGER) AS whole_value, ts AS at_ts, CAST(user_id AS VARCHAR) AS user_text FROM events
""", as_text=["type_code"])
def typed_staging(t: Tables):
    rows = t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("type_code"),
                           F.floor("value").alias("whole_value"), F.col("ts").alias("at_ts"),
                           F.col("user_id").alias("user_text"))
    return stage_typed(rows, layout(
        "id int, type_code int, whole_value int, at_ts timestamp_ntz, user_text string"))


# Texts of which a part does not fit the layout: words and a number that is too large.
RAW_SQL = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_type = 'error' THEN event_type WHEN event_type = 'signup' THEN NULL
              WHEN event_id % 10 = 3 THEN '99999999999' ELSE CAST(user_id AS VARCHAR) END AS code,
         CASE WHEN event_id % 7 = 0 THEN 'soon' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day
  FROM events),
judged AS (
  SELECT *, code IS NOT NULL AND TRY_CAST(code AS INTEGER) IS NULL AS bad_code,
         TRY_CAST(day AS DATE) IS NULL AS bad_day FROM raw)"""


def raw_staging(t: Tables):
    kind, number = F.col("event_type"), F.col("event_id")
    raw = t.events.select(
        number.cast("string").alias("c1"),
        F.when(kind == "error", kind).when(kind == "signup", None)
        .when(number % 10 == 3, "99999999999").otherwise(F.col("user_id").cast("string")).alias("c2"),
        F.when(number % 7 == 0, "soon").otherwise(F.to_date("ts").cast("string")).alias("c3"))
    return stage_checked(raw, layout("id bigint, code int, day date"), by_position=True)


@query(f"WITH {RAW_SQL} SELECT CAST(id AS BIGINT) AS id, CAST(code AS INTEGER) AS code, "
       "CAST(day AS DATE) AS day FROM judged WHERE NOT bad_code AND NOT bad_day", as_text=["code", "day"])
def staging_good(t: Tables):
    return raw_staging(t).good


@query(f"""
WITH {RAW_SQL}, bad AS (
  SELECT 'code' AS "column", code AS text, id, CASE WHEN code = 'error' THEN 'not a value of type int'
         ELSE 'out of range of int' END AS reason FROM judged WHERE bad_code
  UNION ALL SELECT 'day', day, id, 'not a value of type date' FROM judged WHERE bad_day)
SELECT "column", text, reason, id AS of_row FROM bad
""")
def staging_bad(t: Tables):
    return raw_staging(t).bad.select("column", "text", "reason",
                                     F.get_json_object("row", "$.id").alias("of_row"))


@query(f"""
WITH {RAW_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT bad_code AND NOT bad_day) AS n_good,
       count(*) FILTER (WHERE bad_code OR bad_day) AS n_bad_rows,
       count(*) FILTER (WHERE bad_code) + count(*) FILTER (WHERE bad_day) AS n_bad_values, 1 AS adds_up
FROM judged
""")
def staging_counts(t: Tables):
    return raw_staging(t).counts


@query("""
SELECT event_id, ts, event_type, value, user_id FROM events
WHERE NOT (ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20')
UNION ALL
SELECT event_id, ts, event_type, value * 2, NULL FROM events
WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20'
  AND event_type = 'purchase' AND CAST(ts AS DATE) <> DATE '2024-01-15'
""", name="replace_slice", as_text=["user_id"])
def slice_replace(t: Tables):
    """A window that starts inside a day, run twice; one day of it has no new rows, and the new
    rows lack a stored column."""
    path = scratch_path(t.spark, "slice")
    rows = t.events.select("event_id", "ts", "event_type", "value")
    append_slice(t.events.select(*rows.columns, "user_id"), path, "ts")
    start, end = "2024-01-10 06:00:00", "2024-01-20"
    new = rows.where(
        (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(end).cast("timestamp_ntz")) & (F.col("event_type") == "purchase")
        & (F.to_date("ts") != F.lit("2024-01-15").cast("date"))
    ).withColumn("value", F.col("value") * 2)
    for _ in range(2):
        replace_slice(new, path, "ts", start, end)
    return read_slices(t.spark, path)


@query("""
SELECT event_id, ts, value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, ts, value FROM events WHERE event_type <> 'error'
""", name="append_slice")
def slice_append(t: Tables):
    path = scratch_path(t.spark, "append")
    rows = t.events.select("event_id", "ts", "value", "event_type")
    for cond in (F.col("event_type") == "view", F.col("event_type") != "error"):
        append_slice(rows.where(cond).drop("event_type"), path, "ts")
    return read_slices(t.spark, path)


@query("""
WITH s AS (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n, count(*) FILTER (WHERE value >= 20) AS n_large FROM events GROUP BY 1, 2)
SELECT CAST(d AS VARCHAR) AS Sensors_Date, 'events' AS ProgramID, event_type AS CustomGroup1, '' AS CustomGroup2, 'Rows' AS Sensors_Name,
       CASE WHEN d >= DATE '2024-01-15' AND event_type <> 'error' THEN n_large ELSE n END AS Sensors_Value_Num,
       CASE WHEN d >= DATE '2024-01-15' AND event_type <> 'error' THEN NULL ELSE 'first' END AS note FROM s
""", name="upsert_sensor")
def sensor_upsert(t: Tables):
    """Second run brings new values for part of the keys of the later days, without the note."""
    path = scratch_path(t.spark, "sensor")

    def sensor(rows, value):
        return rows.groupBy(F.to_date("ts").alias("Sensors_Date"),
                            F.col("event_type").alias("CustomGroup1")) \
            .agg(value.alias("Sensors_Value_Num")) \
            .withColumns({"ProgramID": F.lit("events"), "CustomGroup2": F.lit(""),
                          "Sensors_Name": F.lit("Rows")})

    events = t.events
    later = events.where((F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
                         & (F.col("event_type") != "error"))
    first = sensor(events, F.count("*")).withColumn("note", F.lit("first"))
    upsert(first, path, SENSOR_KEY, "Sensors_Date")
    upsert(sensor(later, F.count_if(F.col("value") >= 20)), path, SENSOR_KEY, "Sensors_Date")
    return read_slices(t.spark, path)


@query("""
SELECT event_id, ts FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < TIMESTAMP '2024-01-20')
""")
def high_water_mark(t: Tables):
    """Rows stored up to a day; the next run starts on the newest stored day."""
    path = scratch_path(t.spark, "mark")
    rows = t.events.select("event_id", "ts")
    append_slice(rows.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")), path, "ts")
    window = RunWindow.next_day(newest_day(t.spark, path))
    return time_slice(read_slices(t.spark, path, window.start), "ts", window.start, window.end)
