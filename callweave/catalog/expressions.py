"""Scans, projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.catalog.registry import Tables, query
from callweave.functions import dates, nulls, tags, text
from callweave.operators.shape import add_prefix, without
from callweave.sources.tables import covering, time_slice


@query("""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'
""")
def scan_window(t: Tables):
    rows = time_slice(t.events, "ts", "2024-01-05 06:00:00", "2024-01-20 18:00:00")
    return rows.select("event_id", "ts", "user_id", "event_type")


@query("""
WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
                  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
           FROM orders)
SELECT o_custkey, o_orderkey FROM v
WHERE valid_from <= TIMESTAMP '1998-03-01' AND valid_to >= TIMESTAMP '1998-03-08'
""")
def covering_validity(t: Tables):
    return covering(order_versions(t), "valid_from", "valid_to", "1998-03-01 00:00:00",
                    "1998-03-08 00:00:00", ["o_custkey", "o_orderkey"])


def order_versions(t: Tables):
    """Validity rows of a customer: from one order to the next."""
    from callweave.operators.ordered import with_next
    from callweave.operators.skew import find_hot

    orders = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"))
    hot = find_hot(orders, ["o_custkey"])
    return with_next(orders, ["o_custkey"], ["valid_from", "o_orderkey"],
                     {"valid_to": "valid_from"}, hot=hot)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'ORDERS' AS source_tag, 'NA' AS extra_1, CAST(NULL AS VARCHAR) AS interaction_id,
       CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority AS contact_key,
       CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS is_large,
       o_orderdate AS loaded_at
FROM orders
""")
def enrich_project(t: Tables):
    return t.orders.select(
        "*", F.lit("ORDERS").alias("source_tag"), F.lit("NA").alias("extra_1"),
        F.lit(None).cast("string").alias("interaction_id"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), "o_orderpriority")
        .alias("contact_key"),
        tags.flag(F.col("o_totalprice") >= 250000).alias("is_large"),
        F.col("o_orderdate").alias("loaded_at"))


@query("""
SELECT event_id AS call_event_id, ts AS call_ts, user_id AS call_user_id,
       event_type AS call_event_type, value, props FROM events
""")
def prefix_columns(t: Tables):
    return add_prefix(t.events, "call_", ["event_id", "ts", "user_id", "event_type"])


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_audit(t: Tables):
    orders = t.orders
    return orders.select(*without(orders.columns, ["o_orderstatus", "o_orderpriority"]))


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE (o_orderstatus <> 'F' AND o_totalprice > 100000 AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
   OR NOT (o_totalprice <= 450000 OR o_orderdate < TIMESTAMP '1997-01-01')
""")
def filters_compound(t: Tables):
    c = F.col
    urgent = (c("o_orderstatus") != "F") & (c("o_totalprice") > 100000) \
        & c("o_orderpriority").isin("1-URGENT", "2-HIGH")
    late = ~((c("o_totalprice") <= 450000)
             | (c("o_orderdate") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")))
    return t.orders.where(urgent | late) \
        .select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("""
SELECT p_partkey, p_name,
       CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_name END AS reason,
       CASE WHEN lower(p_name) LIKE '%ring%' THEN 1 ELSE 0 END AS has_ring
FROM part
WHERE p_name NOT LIKE 'red%' AND
      NOT coalesce((CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_name END) LIKE '%bolt%', false)
""")
def filters_like(t: Tables):
    parts = t.part.withColumn("reason", F.when(F.col("p_type") != "ECONOMY", F.col("p_name")))
    kept = parts.where(~text.like(F.col("p_name"), "red%")
                       & nulls.keep_unless(text.like(F.col("reason"), "%bolt%")))
    return kept.select("p_partkey", "p_name", "reason",
                       tags.flag(text.like(F.col("p_name"), "%RING%", ci=True)).alias("has_ring"))


@query("""
SELECT o.o_orderkey, o.o_custkey, c.c_name FROM orders o LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey IS NULL OR o.o_orderpriority IS NOT NULL AND c.c_mktsegment IS NOT NULL
""")
def filters_null(t: Tables):
    positive = t.customer.where(F.col("c_acctbal") > 0)
    rows = t.orders.join(positive, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.where(F.col("c_custkey").isNull() | (
        F.col("o_orderpriority").isNotNull() & F.col("c_mktsegment").isNotNull())) \
        .select("o_orderkey", "o_custkey", "c_name")


SCOPES = {"contact": ["view", "click"], "result": ["purchase", "signup"]}


@query("""
SELECT event_id, event_type,
       CASE WHEN event_type IN ('view', 'click') THEN 'contact'
            WHEN event_type IN ('purchase', 'signup') THEN 'result' ELSE 'other' END AS scope,
       CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN 1 ELSE 0 END AS in_scope,
       CASE WHEN value = 0 THEN 'N' WHEN value >= 50 THEN 'Y' END AS is_big
FROM events
""")
def case_tags(t: Tables):
    codes = [c for part in SCOPES.values() for c in part]
    return t.events.select(
        "event_id", "event_type",
        tags.tag_by_list(F.col("event_type"), SCOPES).alias("scope"),
        tags.flag(tags.in_list(F.col("event_type"), codes)).alias("in_scope"),
        F.when(F.col("value") == 0, "N").when(F.col("value") >= 50, "Y").alias("is_big"))


@query("""
WITH x AS (SELECT event_id, value, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind FROM events)
SELECT event_id, coalesce(kind, 'NA') AS kind_na, coalesce(kind, CAST(event_id AS VARCHAR)) AS kind_or_id,
       CASE WHEN kind = 'view' THEN 1 WHEN NOT (kind = 'view') THEN 0 END AS is_view,
       coalesce(kind, 'NA') || '_' || CAST(event_id AS VARCHAR) AS pasted,
       kind || '_x' AS concatenated
FROM x
""", as_text=["is_view"])
def null_defaults(t: Tables):
    kind = F.col("kind")
    return t.events.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type"))) \
        .select("event_id", nulls.text_or_na(kind).alias("kind_na"),
                F.coalesce(kind, F.col("event_id").cast("string")).alias("kind_or_id"),
                nulls.if_else(kind == "view", 1, 0).alias("is_view"),
                nulls.paste(kind, F.lit("_"), F.col("event_id")).alias("pasted"),
                F.concat(kind, F.lit("_x")).alias("concatenated"))


@query("""
WITH x AS (SELECT event_id, CAST(floor(value) AS BIGINT) AS a,
                  CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS b FROM events)
SELECT event_id, CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE greatest(a, b) END AS strict_greatest,
       greatest(a, coalesce(b, 0)) AS greatest_defaulted,
       CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE least(a, b) END AS strict_least
FROM x
""", as_text=["strict_greatest", "strict_least"])
def greatest_least(t: Tables):
    a, b = F.floor("value"), F.when(F.col("event_type") != "view", F.col("user_id"))
    return t.events.select(
        "event_id", nulls.greatest_strict(a, b).alias("strict_greatest"),
        F.greatest(a, F.coalesce(b, F.lit(0))).alias("greatest_defaulted"),
        nulls.least_strict(a, b).alias("strict_least"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 200000 THEN 'H' ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def conditional_update(t: Tables):
    cond = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 200000)
    return t.orders.select("o_orderkey", nulls.update_where(
        cond, F.lit("H"), F.col("o_orderstatus")).alias("o_orderstatus"))


@query("""
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS reason FROM orders)
SELECT o_orderkey, reason FROM x WHERE NOT coalesce(reason LIKE '%LOW%', false)
""")
def conditional_delete(t: Tables):
    reason = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", reason.alias("reason")) \
        .where(nulls.keep_unless(text.like(F.col("reason"), "%LOW%")))


@query(r"""
WITH raw AS (
  SELECT c_custkey,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '000000' WHEN 'MACHINERY' THEN '   '
              WHEN 'FURNITURE' THEN '''' || right(c_name, 9) || '  ' WHEN 'BUILDING' THEN NULL
              ELSE ' ' || c_name || 'X' END AS t FROM customer),
k AS (SELECT c_custkey, t, substring(regexp_replace(trim(t), '^''', ''), 1, 12) AS contract FROM raw)
SELECT c_custkey, contract,
       CASE WHEN regexp_matches(contract, '^0+$') THEN 'zero'
            WHEN length(trim(contract)) = 0 THEN 'blank' ELSE 'valid' END AS contract_status,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
            ELSE CAST(c_custkey AS VARCHAR) END AS padded,
       nullif(regexp_extract(t, '[[:alnum:]]+'), '') AS alnum_run,
       nullif(regexp_extract(lower(trim(t)), '^customer#\d{1,4}'), '') AS code,
       CASE WHEN regexp_matches(t, '(?i)CUSTOMER') THEN 1 ELSE 0 END AS named,
       CASE WHEN length(t) > 9 THEN 1 ELSE 0 END AS is_long,
       left(t, 4) AS head
FROM k
""")
def key_status(t: Tables):
    seg = F.col("c_mktsegment")
    raw = (
        F.when(seg == "HOUSEHOLD", "000000").when(seg == "MACHINERY", "   ")
        .when(seg == "FURNITURE", F.concat(F.lit("'"), F.right("c_name", F.lit(9)), F.lit("  ")))
        .when(seg == "BUILDING", None)
        .otherwise(F.concat(F.lit(" "), "c_name", F.lit("X")))
    )
    rows = t.customer.select("c_custkey", raw.alias("t"))
    contract = text.contract_key(F.col("t"))
    return rows.select(
        "c_custkey", contract.alias("contract"),
        text.key_status(contract).alias("contract_status"),
        text.pad_left(F.col("c_custkey"), 3).alias("padded"),
        text.first_alnum(F.col("t")).alias("alnum_run"),
        text.first_match(F.lower(text.strip(F.col("t"))), r"^customer#\d{1,4}").alias("code"),
        tags.flag(text.contains_ci(F.col("t"), "CUSTOMER")).alias("named"),
        tags.flag(F.length("t") > 9).alias("is_long"),
        F.left("t", F.lit(4)).alias("head"))


@query("""
WITH x AS (SELECT o_orderkey, o_orderdate, o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 2) AS ts FROM orders)
SELECT o_orderkey,
       CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
       CAST(last_day(CAST(o_orderdate AS DATE)) + 1 AS TIMESTAMP) AS next_month,
       CAST(month(o_orderdate) AS INTEGER) AS month_number,
       CASE WHEN ts = date_trunc('day', ts) THEN ts
            ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY END AS day_ceil,
       ts + INTERVAL 120 SECOND AS buffered,
       CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_in,
       TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN 'bad' ELSE '1999-02-03' END AS TIMESTAMP) AS parsed
FROM x
""")
def date_functions(t: Tables):
    odd = F.col("o_orderkey") % 2
    ts = dates.add_seconds(F.col("o_orderdate"), odd)
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", dates.midnight(dates.first_of_month(day)).alias("month_start"),
        dates.midnight(dates.first_of_next_month(day)).alias("next_month"),
        F.month("o_orderdate").alias("month_number"),
        dates.ceil_day(ts).alias("day_ceil"), dates.add_seconds(ts, 120).alias("buffered"),
        F.date_sub(day, 1).alias("day_before"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days_in"),
        dates.parse_timestamp(F.when(odd == 0, "bad").otherwise("1999-02-03")).alias("parsed"))


@query("""
WITH x AS (SELECT event_id, ts, value, ts + INTERVAL 1 SECOND * CAST(floor(value) AS BIGINT) AS end_ts,
                  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events)
SELECT event_id, end_ts, CAST(date_sub('second', ts, next_ts) AS BIGINT) AS gap_s,
       CAST(abs(date_sub('second', next_ts, end_ts)) AS BIGINT) AS abs_s,
       round(value / 3 * 100, 6) AS share
FROM x
""", as_text=["abs_s", "gap_s"])
def duration_functions(t: Tables):
    from callweave.operators.ordered import with_next
    from callweave.operators.skew import find_hot

    events = t.events
    hot = find_hot(events, ["user_id"])
    rows = with_next(events, ["user_id"], ["ts", "event_id"], {"next_ts": "ts"}, hot=hot) \
        .withColumn("end_ts", dates.add_seconds(F.col("ts"), F.floor("value")))
    return rows.select(
        "event_id", "end_ts",
        dates.seconds_between(F.col("ts"), F.col("next_ts")).alias("gap_s"),
        F.abs(dates.seconds_between(F.col("next_ts"), F.col("end_ts"))).alias("abs_s"),
        F.round(F.col("value") / 3 * 100, 6).alias("share"))
