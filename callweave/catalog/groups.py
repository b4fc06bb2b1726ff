"""Aggregates, ordered windows, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.catalog.joins import calls_and_outcomes, ON
from callweave.catalog.registry import Tables, query
from callweave.functions import dates, tags, text
from callweave.operators.identity import with_dense_number, with_stable_id
from callweave.operators.intervals import match_last
from callweave.operators.lookups import key_set
from callweave.operators.metrics import (
    count_check, mean_gap_seconds, percent, rate_report, sum0, text_list, text_pieces,
    unique_check,
    unmatched_by_day,
)
from callweave.operators.ordered import (
    first_per_group, keep_best, with_group_max, with_row_number,
)
from callweave.operators.shape import (
    harmonise, layout, replace_subset, union_all, union_distinct, unpivot_keys,
)
from callweave.operators.skew import find_hot, hot_limit


@query("""
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10 ORDER BY 2 DESC, 1
""")
def group_having(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 10") \
        .orderBy(F.desc("n"), "o_custkey")


@query("SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id FROM events WHERE event_type = 'view'")
def distinct_days(t: Tables):
    return t.events.where(F.col("event_type") == "view") \
        .select(F.to_date("ts").alias("day"), "user_id").distinct()


@query("""
WITH x AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 1 ELSE 0 END AS a,
                  CASE WHEN value >= 20 THEN 1 ELSE 0 END AS b FROM events)
SELECT day, CAST(coalesce(sum(a), 0) AS BIGINT) AS n_a, count(*) FILTER (WHERE a = 1 AND b = 1) AS n_ab,
       count(*) FILTER (WHERE a = 0 AND b = 1) AS n_b_only
FROM x GROUP BY day
""")
def cond_sums(t: Tables):
    a = F.when(F.col("event_type") == "error", None) \
        .otherwise(tags.flag(F.col("event_type") == "view"))
    rows = t.events.select(F.to_date("ts").alias("day"), a.alias("a"),
                           tags.flag(F.col("value") >= 20).alias("b"))
    return rows.groupBy("day").agg(
        sum0(F.col("a")).alias("n_a"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("n_ab"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("n_b_only"))


@query("SELECT CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS newest_day, max(event_id) AS newest_id FROM events")
def max_mark(t: Tables):
    return t.events.agg(F.to_date(F.max("ts")).alias("newest_day"),
                        F.max("event_id").alias("newest_id"))


@query("""
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       round(coalesce(abs(avg(date_sub('second', o_orderdate, l_shipdate))), 0), 6) AS mean_gap_s
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey GROUP BY 1
""")
def time_gap(t: Tables):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_shipdate")
    return t.orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left") \
        .groupBy(F.to_date("o_orderdate").alias("day")) \
        .agg(F.round(mean_gap_seconds(F.col("o_orderdate"), F.col("l_shipdate")), 6).alias("mean_gap_s"))


@query("""
SELECT o_orderpriority, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
       count(*) FILTER (WHERE o_orderstatus = 'X') AS n_never,
       round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*), 6) AS final_rate,
       round(CAST(count(*) AS DOUBLE) / nullif(count(*) FILTER (WHERE o_orderstatus = 'X'), 0) * 100, 6) AS never_rate
FROM orders GROUP BY 1
""")
def rates(t: Tables):
    out = rate_report(t.orders, ["o_orderpriority"], {
        "n_orders": F.count("*"), "n_final": F.count_if(F.col("o_orderstatus") == "F"),
        "n_never": F.count_if(F.col("o_orderstatus") == "X")},
        {"final_rate": ("n_final", "n_orders"), "never_rate": ("n_orders", "n_never")})
    return out.withColumns({c: F.round(c, 6) for c in ("final_rate", "never_rate")})


@query("""
SELECT l_orderkey, string_agg(CASE WHEN l_returnflag = 'N' THEN 'NA' ELSE l_returnflag END, ','
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey
""")
def ordered_concat(t: Tables):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")]
    return t.lineitem.groupBy("l_orderkey").agg(text_list(flag, order).alias("flags"))


@query("""
WITH v AS (SELECT event_type, event_id, ts, CASE WHEN value >= 5 THEN CAST(user_id AS VARCHAR) ELSE 'NA' END AS v FROM events),
s AS (SELECT *, coalesce(sum(length(v) + 1) OVER (PARTITION BY event_type ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM v)
SELECT event_type, CAST(start // 200 AS BIGINT) AS piece, CAST(greatest(min(start) - 1, 0) AS BIGINT) AS "offset",
       string_agg(CASE WHEN start = 0 THEN v ELSE ',' || v END, '' ORDER BY start) AS text
FROM s GROUP BY event_type, start // 200
""")
def ordered_concat_pieces(t: Tables):
    """The users of each kind of event in order, in pieces of 200 characters; kinds of more than
    500 events are cut."""
    user = F.when(F.col("value") >= 5, F.col("user_id").cast("string"))
    with hot_limit(t.spark, 500):
        return text_pieces(t.events.select("event_type", "event_id", "ts", "value", "user_id"),
                           ["event_type"], user, ["ts", "event_id"], size=200)


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS n_rows,
       CAST(coalesce(sum(CASE WHEN l_quantity > 25 THEN 1 END), 0) AS BIGINT) AS n_large,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts,
       max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1, 2, 3, 4
""")
def group_summary(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n_rows"),
        sum0(F.when(F.col("l_quantity") > 25, 1)).alias("n_large"),
        text_list(F.col("l_partkey"), [F.col("l_partkey")]).alias("parts"),
        F.max("l_shipdate").alias("last_ship"))


@query("""
SELECT count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_purchase,
       round(100.0 * sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) / count(*), 6) AS purchase_rate
FROM events
""")
def global_summary(t: Tables):
    return rate_report(t.events, [], {
        "n_rows": F.count("*"),
        "n_purchase": sum0(tags.flag(F.col("event_type") == "purchase")),
    }, {"purchase_rate": ("n_purchase", "n_rows")}).withColumn("purchase_rate", F.round("purchase_rate", 6))


@query("""
SELECT 'lines' AS check_name, count(l_orderkey) AS n_rows, count(DISTINCT l_orderkey) AS n_distinct,
       CASE WHEN count(l_orderkey) = count(DISTINCT l_orderkey) THEN 1 ELSE 0 END AS is_unique FROM lineitem
UNION ALL
SELECT 'parts', count(l_partkey), count(DISTINCT l_partkey),
       CASE WHEN count(l_partkey) = count(DISTINCT l_partkey) THEN 1 ELSE 0 END FROM lineitem
""")
def uniqueness_check(t: Tables):
    return unique_check(t.lineitem, {"lines": "l_orderkey", "parts": "l_partkey"})


@query("""
WITH j AS (SELECT o.* FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
SELECT 'line lookup' AS check_name, (SELECT count(*) FROM orders) AS n_before, (SELECT count(*) FROM j) AS n_after,
       CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM j) THEN 1 ELSE 0 END AS is_equal
""")
def count_reconcile(t: Tables):
    orders = t.orders
    joined = orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return count_check("line lookup", orders, joined)


@query("""
SELECT CAST(CAST(lo AS DATE) AS VARCHAR) AS day, count(*) AS n_unmatched FROM (
  SELECT c.event_id, c.ts AS lo FROM events c WHERE c.event_type IN ('view', 'click') AND NOT EXISTS (
    SELECT 1 FROM events o WHERE o.event_type = 'purchase' AND o.user_id = c.user_id AND CAST(o.ts AS DATE) = CAST(c.ts AS DATE)
      AND o.ts >= c.ts AND NOT EXISTS (
        SELECT 1 FROM events n WHERE n.event_type IN ('view', 'click') AND n.user_id = c.user_id
          AND n.ts > c.ts AND n.ts <= o.ts))) GROUP BY 1
""", name="unmatched_by_day")
def unmatched_daily(t: Tables):
    calls, outcomes = calls_and_outcomes(t)
    matched = match_last(calls, outcomes, ON, "lo", "hi", "o_ts", "outcome_id")
    return unmatched_by_day(matched, "lo", "outcome_id")


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
""")
def row_number_key(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    hot = find_hot(orders, ["o_custkey"])
    return with_row_number(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], hot=hot) \
        .select("o_orderkey", F.col("rn").cast("bigint").alias("rn"))


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
""")
def row_number_large_keys(t: Tables):
    """``row_number_key`` with every customer of more than three orders cut into ranges."""
    with hot_limit(t.spark, 3):
        return row_number_key(t)


@query("""
WITH x AS (SELECT p_brand, p_type, CASE WHEN p_size > 25 THEN p_size END AS size FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type, size) AS copy FROM x)
SELECT sha256('v' || length(p_brand) || ':' || p_brand || 'v' || length(p_type) || ':' || p_type ||
       CASE WHEN size IS NULL THEN 'n' ELSE 'v' || length(CAST(size AS VARCHAR)) || ':' || CAST(size AS VARCHAR) END)
       || '-' || copy AS row_id, p_brand, p_type, size FROM n
""", as_text=["size"])
def stable_id(t: Tables):
    rows = t.part.select("p_brand", "p_type",
                         F.when(F.col("p_size") > 25, F.col("p_size")).alias("size"))
    return with_stable_id(rows, "row_id")


@query("""
WITH x AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events)
SELECT row_number() OVER (ORDER BY day, user_id, event_type) AS row_id, user_id, event_type, day FROM x
""", as_text=["day"])
def dense_number(t: Tables):
    """Numbers 1..N over the whole table, as a script would give them to its rows."""
    rows = t.events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    return with_dense_number(rows, "row_id", order=["day", "user_id"])


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""", name="first_per_group")
def largest_order(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_group(orders, ["o_custkey"], [
        F.desc("o_totalprice"), F.desc("o_orderdate"), F.asc("o_orderkey")]).drop("o_orderdate")


@query("""
WITH x AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) || CAST(CAST(ts AS DATE) AS VARCHAR) END AS call_ref,
                  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_sale, ts FROM events)
SELECT event_id, call_ref, is_sale FROM (
  SELECT *, row_number() OVER (PARTITION BY call_ref ORDER BY is_sale DESC, ts DESC, event_id) AS rn FROM x)
WHERE rn = 1 OR call_ref IS NULL
""", name="keep_best")
def keep_best_per_id(t: Tables):
    rows = t.events.select(
        "event_id", "ts", tags.flag(F.col("event_type") == "purchase").alias("is_sale"),
        F.when(F.col("event_type") != "error", F.concat(
            F.col("user_id").cast("string"), F.to_date("ts").cast("string"))).alias("call_ref"))
    return keep_best(rows, "call_ref", [F.desc("is_sale"), F.desc("ts"), F.asc("event_id")]) \
        .select("event_id", "call_ref", "is_sale")


@query("SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey, o_orderstatus) AS top_price FROM orders")
def partition_max(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return with_group_max(orders, ["o_custkey", "o_orderstatus"], "o_totalprice", "top_price") \
        .select("o_orderkey", "top_price")


PARTY_SQL = """SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer
{op} SELECT s_nationkey, 'SUPPLIER' FROM supplier"""


def _parties(t: Tables):
    return (t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label")),
            t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("label")))


@query(PARTY_SQL.format(op="UNION"), name="union_distinct")
def union_distinct_rows(t: Tables):
    return union_distinct(*_parties(t))


@query("""SELECT c_nationkey AS nation, c_mktsegment AS label, NULL AS balance FROM customer
UNION ALL SELECT s_nationkey, 'SUPPLIER', s_acctbal FROM supplier""", name="union_all")
def union_all_rows(t: Tables):
    customers, _ = _parties(t)
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("label"),
                                  F.col("s_acctbal").alias("balance"))
    return union_all(customers, suppliers)


@query("""
SELECT user_id AS key FROM events WHERE event_type = 'purchase'
UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000
UNION SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R'
""")
def key_set_union(t: Tables):
    return key_set((t.events.where(F.col("event_type") == "purchase"), "user_id"),
                   (t.orders.where(F.col("o_totalprice") > 400000), "o_custkey"),
                   (t.lineitem.where(F.col("l_returnflag") == "R"), "l_suppkey"))


@query("""
WITH fresh AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey NOT IN (SELECT k FROM fresh)
UNION ALL SELECT k, v FROM fresh
""", name="replace_subset")
def replace_subset_rows(t: Tables):
    base = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    fresh = t.orders.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("k")) \
        .agg(F.max("o_totalprice").alias("v"))
    return replace_subset(base, fresh, "k")


@query("""
WITH l AS (SELECT p_partkey, p_retailprice, 'p_brand' AS kind, 1 AS pr, p_brand AS word FROM part
  UNION ALL SELECT p_partkey, p_retailprice, 'p_type', 2, CASE WHEN p_size > 10 THEN p_type END FROM part
  UNION ALL SELECT p_partkey, p_retailprice, 'p_name', 3, p_name FROM part)
SELECT word, kind, p_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY pr, p_retailprice DESC, p_partkey) AS rn FROM l WHERE word IS NOT NULL)
WHERE rn = 1
""")
def unpivot_priority(t: Tables):
    levels = ["p_brand", "p_type", "p_name"]
    part = t.part.withColumn("p_type", F.when(F.col("p_size") > 10, F.col("p_type")))
    long = unpivot_keys(part, ["p_partkey", "p_retailprice"], levels, "kind", "word")
    best = first_per_group(long, ["word"], [
        tags.rank_by_levels(F.col("kind"), levels).asc(), F.desc("p_retailprice"), F.asc("p_partkey")])
    return best.select("word", "kind", "p_partkey")


PARTY_LAYOUT = layout(
    "source string, party_id bigint, party_name string, balance double, segment string, stored_at timestamp_ntz")


@query("""
SELECT 'CUSTOMER' AS source, c_custkey AS party_id, c_name AS party_name, c_acctbal AS balance,
       c_mktsegment AS segment, CAST(NULL AS TIMESTAMP) AS stored_at FROM customer
UNION SELECT 'SUPPLIER', s_suppkey, s_name, s_acctbal, 'NA', NULL FROM supplier
""")
def harmonise_two_sources(t: Tables):
    customers = harmonise(t.customer, PARTY_LAYOUT, {
        "source": F.lit("CUSTOMER"), "party_id": F.col("c_custkey"), "party_name": F.col("c_name"),
        "balance": F.col("c_acctbal"), "segment": F.col("c_mktsegment")})
    suppliers = harmonise(t.supplier, PARTY_LAYOUT, {
        "source": F.lit("SUPPLIER"), "party_id": F.col("s_suppkey"), "party_name": F.col("s_name"),
        "balance": F.col("s_acctbal")})
    return union_distinct(customers, suppliers)
