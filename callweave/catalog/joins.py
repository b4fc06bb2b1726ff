"""Joins: lookups, interval matches, validity lookups and membership tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.catalog.expressions import order_versions
from callweave.catalog.registry import Tables, query
from callweave.functions import dates
from callweave.operators.intervals import match_all, match_last
from callweave.operators.lookups import (
    any_key_member, anti, expand_entities, join_suffix, key_set, scd_lookup, scd_lookup_last, semi,
)
from callweave.operators.metrics import percent
from callweave.operators.ordered import first_per_group, with_next, with_next_or_max
from callweave.operators.skew import find_hot, hot_limit

# Event times moved into the years of the order dates: one event day becomes 60 order days.
PROBE_SQL = """probe AS (
  SELECT event_id, user_id, event_type,
         TIMESTAMP '1995-06-01' + INTERVAL 1 SECOND * (60 * date_sub('second', TIMESTAMP '2024-01-01', ts)) AS at_ts
  FROM events)"""
VERSIONS_SQL = """versions AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from,
         lead(o_orderdate, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
  FROM orders)"""


def probe(t: Tables) -> DataFrame:
    seconds = dates.seconds_between(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    base = F.lit("1995-06-01 00:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", "user_id", "event_type",
                           dates.add_seconds(base, seconds * 60).alias("at_ts"))


def versions(t: Tables) -> DataFrame:
    """Overlapping validity rows: from an order to the second next one."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority",
                           F.col("o_orderdate").alias("valid_from"))
    hot = find_hot(rows, ["o_custkey"])
    for src, name in (("valid_from", "_n1"), ("_n1", "valid_to")):
        rows = with_next(rows, ["o_custkey"], ["valid_from", "o_orderkey"], {name: src}, hot=hot)
    return rows.drop("_n1")


@query("""
SELECT o_orderkey, c_name, n_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 1000
LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def left_join_map(t: Tables):
    rich = t.customer.where(F.col("c_acctbal") > 1000)
    return t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left") \
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select("o_orderkey", "c_name", "n_name")


@query("""
SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def inner_filter_join(t: Tables):
    active = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return t.orders.join(active, F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "c_custkey", "c_mktsegment")


@query("""
WITH l AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer),
     r AS (SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal, s_nationkey FROM supplier)
SELECT l.k, l.name, l.bal, r.name AS name_y, r.bal AS bal_y, r.s_nationkey FROM l LEFT JOIN r ON l.k = r.k
""", name="join_suffix", as_text=["s_nationkey"])
def join_suffixed(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("bal"))
    right = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
                              F.col("s_acctbal").alias("bal"), "s_nationkey")
    return join_suffix(left, right, [("k", "k")])


SUCCESSOR_SQL = """
WITH n AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS k, ts FROM events),
     r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn FROM n)
SELECT a.event_id, a.k, b.ts AS next_ts, b.event_id AS next_id
FROM r a LEFT JOIN r b ON a.k = b.k AND a.rn + 1 = b.rn
"""


@query(SUCCESSOR_SQL, as_text=["k", "next_id"])
def successor(t: Tables):
    rows = t.events.select("event_id", "ts", F.when(F.col("event_type") != "error",
                                                    F.col("user_id")).alias("k"))
    hot = find_hot(rows, ["k"])
    return with_next(rows, ["k"], ["ts", "event_id"], {"next_ts": "ts", "next_id": "event_id"},
                     hot=hot, null_keys="never").select("event_id", "k", "next_ts", "next_id")


@query(SUCCESSOR_SQL, as_text=["k", "next_id"])
def successor_large_keys(t: Tables):
    """``successor`` with every user of more than three events cut into ranges."""
    with hot_limit(t.spark, 3):
        return successor(t)


@query("""
WITH e AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS d, ts + INTERVAL 1 SECOND * CAST(floor(value) AS BIGINT) AS end_ts FROM events)
SELECT event_id, lead(ts, 1, (SELECT NULL)) OVER w IS NULL AS is_last,
       coalesce(lead(ts) OVER w, max(end_ts) OVER (PARTITION BY user_id, d) + INTERVAL 5 MINUTE) AS next_ts
FROM e WINDOW w AS (PARTITION BY user_id, d ORDER BY ts, event_id)
""")
def next_with_max_default(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("d"),
                           dates.add_seconds(F.col("ts"), F.floor("value")).alias("end_ts"))
    hot = find_hot(rows, ["user_id", "d"])
    keys, order = ["user_id", "d"], ["ts", "event_id"]
    out = with_next_or_max(rows, keys, order, "ts", "end_ts", "INTERVAL '5' MINUTE", "next_ts",
                           hot=hot)
    out = with_next(out, keys, order, {"_n": "event_id"}, hot=hot)
    return out.select("event_id", F.col("_n").isNull().alias("is_last"), "next_ts")


@query("""
SELECT event_id,
       coalesce(lead(ts) OVER m, CAST(last_day(CAST(ts AS DATE)) + 1 AS TIMESTAMP)) AS month_end,
       coalesce(lead(ts) OVER d, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)) AS day_end
FROM events WINDOW m AS (PARTITION BY user_id ORDER BY ts, event_id),
                   d AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)
""")
def next_with_calendar_default(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("d"))
    order = ["ts", "event_id"]
    rows = with_next(rows, ["user_id"], order, {"month_end": "ts"},
                     hot=find_hot(rows, ["user_id"]))
    rows = with_next(rows, ["user_id", "d"], order, {"day_end": "ts"},
                     hot=find_hot(rows, ["user_id", "d"]))
    return rows.select(
        "event_id",
        F.coalesce("month_end", dates.midnight(dates.first_of_next_month("d"))).alias("month_end"),
        F.coalesce("day_end", dates.ceil_day(F.col("ts"))).alias("day_end"))


@query("""
WITH v AS (SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
           FROM events WHERE event_type = 'view')
SELECT v.event_id AS view_id, p.event_id AS purchase_id, CAST(date_sub('second', v.ts, p.ts) AS BIGINT) AS gap_s
FROM v LEFT JOIN events p ON p.event_type = 'purchase' AND p.value >= 10 AND v.user_id = p.user_id
     AND v.ts < p.ts AND p.ts < v.next_ts
""", as_text=["gap_s", "purchase_id"])
def followup_range(t: Tables):
    events = t.events
    views = events.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    views = with_next(views, ["user_id"], ["ts", "event_id"], {"next_ts": "ts"},
                      hot=find_hot(views, ["user_id"])) \
        .select(F.col("event_id").alias("view_id"), "user_id", "ts", "next_ts")
    sales = events.where((F.col("event_type") == "purchase") & (F.col("value") >= 10)) \
        .select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"),
                F.col("ts").alias("sale_ts"))
    pairs = match_all(views, sales, [("user_id", "buyer")], "ts", "next_ts", "sale_ts",
                      open_start=True)
    return pairs.select("view_id", "purchase_id",
                        dates.seconds_between(F.col("ts"), F.col("sale_ts")).alias("gap_s"))


@query(f"""
WITH {PROBE_SQL}, {VERSIONS_SQL}
SELECT event_id, o_orderkey, o_orderpriority FROM probe
LEFT JOIN versions ON user_id = o_custkey AND at_ts >= valid_from AND at_ts < valid_to
""", as_text=["o_orderkey"])
def scd_half_open(t: Tables):
    return scd_lookup(probe(t), versions(t), [("user_id", "o_custkey")], "at_ts", "valid_from",
                      "valid_to").select("event_id", "o_orderkey", "o_orderpriority")


@query(f"""
WITH {PROBE_SQL}, {VERSIONS_SQL},
c AS (SELECT event_id, o_orderkey, row_number() OVER (PARTITION BY event_id ORDER BY valid_from DESC, valid_to DESC, o_orderkey DESC) AS rn
      FROM (SELECT *, CAST(at_ts AS DATE) AS day FROM probe)
      LEFT JOIN versions ON user_id = o_custkey AND day >= valid_from AND day <= valid_to)
SELECT event_id, o_orderkey FROM c WHERE rn = 1
""", as_text=["o_orderkey"])
def scd_closed_last(t: Tables):
    facts = probe(t).withColumn("day", dates.midnight(F.to_date("at_ts")))
    return scd_lookup_last(facts, versions(t), [("user_id", "o_custkey")], "day", "valid_from",
                           "valid_to", ["o_orderkey"], closed_end=True) \
        .select("event_id", "o_orderkey")


@query(f"""
WITH {PROBE_SQL}, {VERSIONS_SQL}
SELECT event_id, event_type, o_orderkey FROM probe LEFT JOIN versions
  ON (event_type IN ('view', 'click') AND user_id = o_custkey AND at_ts >= valid_from AND at_ts < valid_to)
  OR (event_type NOT IN ('view', 'click') AND event_id = o_orderkey AND at_ts >= valid_from AND at_ts < valid_to)
""", as_text=["o_orderkey"])
def scd_by_tag(t: Tables):
    """Two key rules chosen by a row tag, as one equi-join on (tag, key)."""
    tag = F.when(F.col("event_type").isin("view", "click"), "A").otherwise("B")
    facts = probe(t).withColumns({
        "tag": tag, "key": F.when(tag == "A", F.col("user_id")).otherwise(F.col("event_id"))})
    v = versions(t)
    rules = [v.withColumns({"_tag": F.lit(n), "_key": F.col(k)})
             for n, k in (("A", "o_custkey"), ("B", "o_orderkey"))]
    return scd_lookup(facts, rules[0].unionByName(rules[1]), [("tag", "_tag"), ("key", "_key")],
                      "at_ts", "valid_from", "valid_to").select("event_id", "event_type", "o_orderkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN c_name ELSE o_orderpriority END AS owner,
       CASE WHEN o_orderstatus = 'F' THEN c_nationkey END AS owner_nation
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000
""", as_text=["owner_nation"])
def update_join(t: Tables):
    owners = t.customer.where(F.col("c_acctbal") > 5000)
    final = F.col("o_orderstatus") == "F"
    return t.orders.join(owners, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", F.when(final, F.col("c_name")).otherwise(F.col("o_orderpriority")).alias("owner"),
        F.when(final, F.col("c_nationkey")).alias("owner_nation"))


CALLS_SQL = """calls AS (
  SELECT event_id AS call_id, user_id, CAST(ts AS DATE) AS day, ts AS lo,
         coalesce(lead(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id),
                  CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)) AS hi
  FROM events WHERE event_type IN ('view', 'click')),
outcomes AS (SELECT event_id AS outcome_id, user_id AS o_user, CAST(ts AS DATE) AS o_day, ts AS o_ts
             FROM events WHERE event_type = 'purchase')"""


def calls_and_outcomes(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = t.events.withColumn("day", F.to_date("ts"))
    calls = events.where(F.col("event_type").isin("view", "click"))
    calls = with_next(calls, ["user_id", "day"], ["ts", "event_id"], {"hi": "ts"},
                      hot=find_hot(calls, ["user_id", "day"]))
    calls = calls.select(F.col("event_id").alias("call_id"), "user_id", "day",
                         F.col("ts").alias("lo"),
                         F.coalesce("hi", dates.midnight(F.date_add("day", 1))).alias("hi"))
    outcomes = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("outcome_id"), F.col("user_id").alias("o_user"),
        F.col("day").alias("o_day"), F.col("ts").alias("o_ts"))
    return calls, outcomes


ON = [("user_id", "o_user"), ("day", "o_day")]


MATCH_LAST_SQL = f"""
WITH {CALLS_SQL}, m AS (
  SELECT call_id, outcome_id, row_number() OVER (PARTITION BY call_id ORDER BY o_ts DESC, outcome_id DESC) AS rn
  FROM calls LEFT JOIN outcomes ON user_id = o_user AND day = o_day AND o_ts >= lo AND o_ts < hi)
SELECT call_id, outcome_id FROM m WHERE rn = 1
"""


@query(MATCH_LAST_SQL, name="match_last", as_text=["outcome_id"])
def interval_match_last(t: Tables):
    calls, outcomes = calls_and_outcomes(t)
    return match_last(calls, outcomes, ON, "lo", "hi", "o_ts", "outcome_id") \
        .select("call_id", "outcome_id")


@query(MATCH_LAST_SQL, as_text=["outcome_id"])
def match_last_large_keys(t: Tables):
    """``match_last`` with every user's day of more than three events cut into ranges."""
    with hot_limit(t.spark, 3):
        return interval_match_last(t)


@query("""
WITH calls AS (SELECT event_id AS call_id, user_id, event_type, value, ts AS lo, ts + INTERVAL 40 HOUR AS hi FROM events WHERE event_type IN ('view', 'click', 'error')),
outcomes AS (SELECT event_id AS outcome_id, user_id AS o_user, ts AS o_ts, CASE WHEN value >= 30 THEN 'click' ELSE 'view' END AS o_kind
             FROM events WHERE event_type IN ('purchase', 'signup')),
m AS (SELECT call_id, outcome_id, row_number() OVER (PARTITION BY call_id ORDER BY o_ts DESC, outcome_id DESC) AS rn
      FROM calls LEFT JOIN outcomes ON user_id = o_user AND o_ts >= lo AND o_ts < hi AND event_type <> o_kind)
SELECT call_id, outcome_id FROM m WHERE rn = 1
""", name="match_last_differing", as_text=["outcome_id"])
def interval_match_differing(t: Tables):
    """Last outcome in an overlapping interval whose kind differs from the call's."""
    events = t.events
    calls = events.where(F.col("event_type").isin("view", "click", "error")).select(
        F.col("event_id").alias("call_id"), "user_id", "event_type", F.col("ts").alias("lo"),
        dates.add_seconds(F.col("ts"), 40 * 3600).alias("hi"))
    outcomes = events.where(F.col("event_type").isin("purchase", "signup")).select(
        F.col("event_id").alias("outcome_id"), F.col("user_id").alias("o_user"),
        F.col("ts").alias("o_ts"),
        F.when(F.col("value") >= 30, "click").otherwise("view").alias("o_kind"))
    return match_last(calls, outcomes, [("user_id", "o_user")], "lo", "hi", "o_ts", "outcome_id",
                      differ=("event_type", "o_kind")).select("call_id", "outcome_id")


@query(f"""
WITH {CALLS_SQL}
SELECT call_id, outcome_id, o_ts FROM calls LEFT JOIN outcomes
  ON user_id = o_user AND day = o_day AND o_ts >= lo AND o_ts < hi
""", name="match_all", as_text=["outcome_id"])
def interval_match_all(t: Tables):
    calls, outcomes = calls_and_outcomes(t)
    return match_all(calls, outcomes, ON, "lo", "hi", "o_ts") \
        .select("call_id", "outcome_id", "o_ts")


@query("""
WITH spans AS (
  SELECT event_id AS span_id, user_id, ts AS lo,
         CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '9999-12-31' ELSE ts + INTERVAL 30 HOUR END AS hi
  FROM events WHERE event_type = 'signup')
SELECT span_id, count(e.event_id) AS n, min(e.ts) AS first_ts, max(e.ts) AS last_ts
FROM spans s LEFT JOIN events e ON e.user_id = s.user_id AND e.ts >= lo AND e.ts < hi GROUP BY span_id
""")
def match_all_open_ends(t: Tables):
    """Spans of which a third never end, among short ones; large users are cut."""
    spans = t.events.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("span_id"), F.col("user_id").alias("owner"), F.col("ts").alias("lo"),
        F.when(F.col("event_id") % 3 == 0, F.lit("9999-12-31").cast("timestamp_ntz"))
        .otherwise(dates.add_seconds(F.col("ts"), 30 * 3600)).alias("hi"))
    events = t.events.select("event_id", "user_id", "ts")
    with hot_limit(t.spark, 50):
        pairs = match_all(spans, events, [("owner", "user_id")], "lo", "hi", "ts")
    return pairs.groupBy("span_id").agg(
        F.count("event_id").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(f"""
WITH {CALLS_SQL}, m AS (
  SELECT call_id, lo, outcome_id, row_number() OVER (PARTITION BY call_id ORDER BY o_ts DESC, outcome_id DESC) AS rn
  FROM calls JOIN outcomes ON user_id = o_user AND day = o_day AND o_ts >= lo AND o_ts < hi),
b AS (SELECT outcome_id, row_number() OVER (PARTITION BY outcome_id ORDER BY lo DESC, call_id DESC) AS rn FROM m WHERE rn = 1)
SELECT CAST(o_day AS VARCHAR) AS day, count(*) AS n_outcomes, count(b.outcome_id) AS n_matched,
       round(count(b.outcome_id) * 100.0 / count(*), 6) AS match_rate
FROM outcomes LEFT JOIN (SELECT outcome_id FROM b WHERE rn = 1) b USING (outcome_id) GROUP BY o_day
""")
def daily_match_rate(t: Tables):
    """Calls to outcomes by interval, one call per outcome, daily match rate."""
    calls, outcomes = calls_and_outcomes(t)
    hits = match_last(calls, outcomes, ON, "lo", "hi", "o_ts", "outcome_id") \
        .where(F.col("outcome_id").isNotNull())
    best = first_per_group(hits, ["outcome_id"], [F.desc("lo"), F.desc("call_id")]) \
        .select(F.col("outcome_id").alias("matched_id"))
    return outcomes.join(best, F.col("outcome_id") == F.col("matched_id"), "left") \
        .groupBy(F.col("o_day").alias("day")) \
        .agg(F.count("*").alias("n_outcomes"), F.count("matched_id").alias("n_matched")) \
        .withColumn("match_rate", F.round(percent("n_matched", "n_outcomes"), 6))


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def semi_join(t: Tables):
    big = t.orders.where(F.col("o_totalprice") > 450000)
    return semi(t.customer, big, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def anti_join(t: Tables):
    big = t.orders.where(F.col("o_totalprice") > 450000)
    return anti(t.customer, big, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query("""
WITH keys AS (SELECT l_partkey AS k FROM lineitem WHERE l_quantity >= 50 AND l_discount >= 0.09 AND l_returnflag = 'R'),
     words AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part WHERE p_size = 7 AND p_brand = 'Brand#3')
SELECT p_partkey, p_name, p_type FROM part
WHERE p_partkey IN (SELECT k FROM keys)
   OR (length(p_brand) > 7 AND p_brand IN (SELECT w FROM words))
   OR lower(p_type) IN (SELECT w FROM words)
   OR (length(p_name) > 8 AND split_part(p_name, ' ', 2) IN (SELECT w FROM words))
   OR split_part(p_name, ' ', 1) IN (SELECT w FROM words)
""")
def any_key_membership(t: Tables):
    part = t.part
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    words = key_set((part.where((F.col("p_size") == 7) & (F.col("p_brand") == "Brand#3")).select(first.alias("w")), "w"))
    keys = key_set((t.lineitem.where(
        (F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.09) & (F.col("l_returnflag") == "R")), "l_partkey"))
    found = any_key_member(part, ["p_partkey"], [
        ("part", [F.col("p_partkey")]),
        ("word", [F.when(F.length("p_brand") > 7, F.col("p_brand")), F.lower("p_type"),
                  F.when(F.length("p_name") > 8, second), first]),
    ], {"part": keys, "word": words})
    return found.select("p_partkey", "p_name", "p_type")


@query("""
WITH p AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment || '_' ||
                  CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) AS person FROM customer),
     active AS (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
SELECT DISTINCT person, c_custkey FROM p
WHERE person IN (SELECT person FROM p WHERE c_custkey IN (SELECT o_custkey FROM active))
""")
def entity_expansion(t: Tables):
    people = t.customer.select("c_custkey", F.concat_ws(
        "_", F.col("c_nationkey").cast("string"), "c_mktsegment",
        F.floor(F.col("c_acctbal") / 100).cast("string")).alias("person"))
    active = t.orders.where(F.col("o_totalprice") > 400000).select("o_custkey")
    return expand_entities(people, "person", "c_custkey", active)
