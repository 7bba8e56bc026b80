"""Registered queries: joins of overlapping intervals and as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import JoinAsOf, asof_join
from ..operators.intervals import JoinOverlaps, Span, overlap_join, overlap_totals
from .registry import nth, query, run, t


def _incidents(spark, d):
    """Each error lasts as many minutes as its value says."""
    e = t(spark, d, "events").where("event_type = 'error'")
    lasting = F.make_dt_interval(mins=F.floor("value").cast("int"))
    return e.select(F.col("event_id").alias("incident_id"), F.col("ts").alias("began"), (F.col("ts") + lasting).alias("ended"))


_INCIDENTS = "SELECT event_id AS incident_id, ts AS began, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS ended FROM events WHERE event_type = 'error'"


@query(f"SELECT e.event_id, e.event_type, i.incident_id FROM events e JOIN ({_INCIDENTS}) i ON e.ts >= i.began AND e.ts < i.ended")
def events_in_incidents(spark, d):
    """Points in intervals, without a key."""
    e = t(spark, d, "events").select("event_id", "event_type", "ts")
    return run(e, JoinOverlaps(_incidents(spark, d), Span("ts"), Span("began", "ended"))).select("event_id", "event_type", "incident_id")


@query(f"SELECT event_id, event_type FROM events e WHERE NOT EXISTS (SELECT 1 FROM ({_INCIDENTS}) i WHERE e.ts >= i.began AND e.ts < i.ended)")
def events_outside_incidents(spark, d):
    e = t(spark, d, "events").select("event_id", "event_type", "ts")
    return overlap_join(e, _incidents(spark, d), Span("ts"), Span("began", "ended"), how="anti").select("event_id", "event_type")


_OPEN = "SELECT o_orderkey, o_custkey, o_orderdate AS since, o_orderdate + to_days(7 + 20 * CAST(left(o_orderpriority, 1) AS INTEGER)) AS until FROM orders"


@query(f"SELECT a.o_orderkey, b.o_orderkey AS other, a.o_custkey FROM ({_OPEN}) a JOIN ({_OPEN}) b ON a.o_custkey = b.o_custkey AND a.since < b.until AND b.since < a.until AND a.o_orderkey < b.o_orderkey")
def overlapping_open_orders(spark, d):
    """Intervals against intervals of the same customer; each pair of orders once."""
    days = F.make_dt_interval(days=7 + 20 * F.left("o_orderpriority", F.lit(1)).cast("int"))
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("since"), (F.col("o_orderdate") + days).alias("until"))
    other = o.toDF("other", "cust", "other_since", "other_until")
    both = overlap_join(o, other, Span("since", "until"), Span("other_since", "other_until"), on=[("o_custkey", "cust")])
    return both.where("o_orderkey < other").select("o_orderkey", "other", "o_custkey")


_BANDS = "SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 9 <> 0 THEN s_acctbal - 150 END AS low, CASE WHEN s_suppkey % 10 <> 0 THEN s_acctbal + 150 END AS high FROM supplier"


@query(f"SELECT c_custkey, count(s_suppkey) AS n_bands, min(s_suppkey) AS first_band FROM customer LEFT JOIN ({_BANDS}) ON c_nationkey = s_nationkey AND (low IS NULL OR c_acctbal >= low) AND (high IS NULL OR c_acctbal <= high) GROUP BY c_custkey")
def balances_in_open_bands(spark, d):
    """Numbers in closed bands, of which some have no lower or no upper bound, totalled without pairs; all customers stay."""
    s = t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.when(nth("s_suppkey", 9) != 0, F.col("s_acctbal") - 150).alias("low"), F.when(nth("s_suppkey", 10) != 0, F.col("s_acctbal") + 150).alias("high"))
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    each = overlap_totals(c, s.where("nation IS NOT NULL"), "c_acctbal", Span("low", "high", closed=True), "s_suppkey", on=[("c_nationkey", "nation")])
    return each.groupBy("c_custkey").agg(F.sum("n").alias("n_bands"), F.min("least").alias("first_band"))


@query(
    "SELECT event_id, purchase_id, price FROM (SELECT l.event_id, r.event_id AS purchase_id, r.value AS price, row_number() OVER (PARTITION BY l.event_id ORDER BY r.ts DESC NULLS LAST, r.event_id DESC) AS nth"
    " FROM events l LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') r ON r.user_id = l.user_id AND r.ts <= l.ts WHERE l.event_type <> 'purchase') WHERE nth = 1"
)
def last_price_before_event(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    bought = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("at"), F.col("value").alias("price"))
    rest = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    step = JoinAsOf(bought, "ts", "at", on=["user_id"], columns=["purchase_id", "price"], ties=["purchase_id"])
    return run(rest, step).select("event_id", "purchase_id", "price")


@query(
    "WITH n AS (SELECT l_partkey, l_shipdate, lead(l_shipdate) OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS later FROM (SELECT DISTINCT l_partkey, l_shipdate FROM lineitem))"
    " SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN later <= l_shipdate + INTERVAL 30 DAY THEN later END AS next_shipment FROM lineitem JOIN n USING (l_partkey, l_shipdate)"
)
def next_shipment_of_part(spark, d):
    """Forward, strictly later, within 30 days."""
    shipped = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    later = shipped.select(F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("next_shipment"))
    got = asof_join(shipped, later, "l_shipdate", "next_shipment", on=[("l_partkey", "part")], direction="forward", exact=False, tolerance=F.expr("interval 30 days"))
    return got.select("l_orderkey", "l_linenumber", "l_partkey", "next_shipment")


@query(
    "SELECT event_id, max(CASE WHEN event_type = 'error' THEN ts END) OVER (ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error FROM events"
)
def last_error_of_anyone(spark, d):
    """No key at all: one key holds every row, and all tasks share it."""
    e = t(spark, d, "events").select("event_id", "ts")
    errors = t(spark, d, "events").where("event_type = 'error'").select(F.col("ts").alias("last_error"))
    return asof_join(e, errors, "ts", "last_error").select("event_id", "last_error")
