"""Jobs over the event stream table and its SQL: as-of and interval joins, running
measures, sessions, percentiles (exact and sketched), a cube, streamed windows and
sessions with late rows.  Whole tables; times as microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.cube import cube, rollup
from tessera.operators.intervals import overlap_join, point_join
from tessera.operators.ordered import asof_join, exact_percentiles, in_ranges, sessions
from tessera.operators.sketches import merged, sketch, sketched_percentiles
from tessera.session import scratch_path
from tessera.sources.tables import load
from tessera.sources.writers import materialize
from tessera.streaming.eventtime import EventSessions, EventWindows

HOUR = 3_600_000_000
SESSION_GAP = 6 * HOUR
REACH = 6 * HOUR
QUANTILES = {"p25": 0.25, "p50": 0.5, "p90": 0.9}
SKETCH_BITS = 7
#: the replayed stream: one batch a period of arrival, one event in ten is two days under way
PERIOD = 6 * 24 * HOUR
ONE_IN, UNDER_WAY = 10, 48 * HOUR
WINDOW, SLIDE, DELAY = 24 * HOUR, 12 * HOUR, 12 * HOUR


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone is."""
    return F.expr(f"datediff(CAST({ts} AS DATE), DATE'1970-01-01') * 86400000000L + hour({ts}) * 3600000000L "
                  f"+ minute({ts}) * 60000000L + CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT)")


def _events(spark: SparkSession, d: str, kind: str | None = None) -> DataFrame:
    events = load(spark, d, "events")
    if kind:
        events = events.where(F.col("event_type") == kind)
    return events.select("user_id", micros("ts").alias("t"), "event_id",
                         F.round(F.col("value") * 100).cast("bigint").alias("cents"))


def q_asof_last_click(spark, d):
    """Each purchase with the user's latest click not after it."""
    found = asof_join(_events(spark, d, "purchase"), _events(spark, d, "click"), ["user_id"], "t", prefix="click_")
    return found.select("event_id", F.col("click_event_id").alias("click_id"),
                        (F.col("t") - F.col("click_t")).alias("waited"))


def q_asof_next_purchase(spark, d):
    """Each click with the user's first purchase after it, within ``REACH``."""
    found = asof_join(_events(spark, d, "click"), _events(spark, d, "purchase"), ["user_id"], "t",
                      direction="forward", exact=False, tolerance=F.lit(REACH), prefix="bought_")
    return found.select("event_id", F.col("bought_event_id").alias("purchase_id"), "bought_cents")


def q_running_user_totals(spark, d):
    """Per event: the user's sum, count and maximum so far, and the neighbouring events."""
    rows = in_ranges(_events(spark, d), ["user_id"], ["t", "event_id"])
    return (rows.running({"total_cents": ("sum", "cents"), "most_cents": ("max", "cents")})
            .ranked("place", "of").shifted({"prev_id": ("event_id", -1), "next_id": ("event_id", 1)}).result()
            .select("event_id", "total_cents", "most_cents", F.col("place").cast("bigint").alias("place"), "of",
                    "prev_id", "next_id"))


def q_user_sessions(spark, d):
    return sessions(_events(spark, d), ["user_id"], "t", F.lit(SESSION_GAP))


def q_price_percentiles(spark, d):
    """Exact percentiles of prices by return flag: three groups, each a large share of all rows."""
    items = load(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("price"))
    return exact_percentiles(items, ["l_returnflag"], "price", QUANTILES)


def q_purchases_after_clicks(spark, d):
    """Pairs of a click and a purchase of the same user at most ``REACH`` later, by click."""
    clicks = _events(spark, d, "click")
    pairs = point_join(_events(spark, d, "purchase"), clicks, ["user_id"], F.col("t"),
                       (F.col("t"), F.col("t") + REACH), prefix="click_")
    return pairs.groupBy(F.col("click_event_id").alias("click_id")).agg(
        F.count(F.lit(1)).alias("n_purchases"), F.sum("cents").alias("cents"))


def q_session_overlaps(spark, d):
    """Pairs of a click session and an error session of one user that overlap in time, by user.
    A user's sessions of one kind are apart, so the pairs are linear in the sessions."""
    bounds = (F.col("session_start"), F.col("session_end") + 1)
    clicks, errors = (sessions(_events(spark, d, kind), ["user_id"], "t", F.lit(SESSION_GAP))
                      for kind in ("click", "error"))
    pairs = overlap_join(clicks, errors, ["user_id"], bounds, bounds, prefix="error_")
    return (pairs.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_pairs"),
                 F.sum(F.least("session_end", "error_session_end")
                       - F.greatest("session_start", "error_session_start")).alias("shared")))


def _sales(spark, d):
    return load(spark, d, "orders").select("o_orderstatus", "o_orderpriority",
                                           F.year("o_orderdate").alias("order_year"),
                                           F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"))


def q_sales_cube(spark, d):
    return cube(_sales(spark, d), ["o_orderstatus", "o_orderpriority", "order_year"], {"cents": F.col("c")})


def q_sales_rollup(spark, d):
    return rollup(_sales(spark, d), ["order_year", "o_orderstatus"], {"cents": F.col("c")})


def q_price_percentile_sketch(spark, d):
    """Percentiles of prices by return flag from sketches by flag and year, stored and merged."""
    items = load(spark, d, "lineitem").select("l_returnflag", F.year("l_shipdate").alias("year"),
                                              F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    stored = materialize(sketch(items, ["l_returnflag", "year"], "cents", SKETCH_BITS), spark, "sketches")
    return sketched_percentiles(merged(stored, ["l_returnflag"]), ["l_returnflag"], QUANTILES)


def _replayed(spark: SparkSession, d: str, folded):
    """The events as they arrive, one file drop and one run of the streaming query a period:
    each run resumes from the checkpoint of the run before."""
    events = load(spark, d, "events").select("event_type", "user_id", micros("ts").alias("t"), "event_id",
                                             F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    arrival = F.col("t") + F.when(F.col("event_id") % ONE_IN == 0, UNDER_WAY).otherwise(0)
    dealt = materialize(events.withColumn("drop", F.floor(arrival / PERIOD)), spark, "arrivals", ["drop"])
    source, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "arrived-ckpt")
    for (drop,) in sorted(dealt.select("drop").distinct().collect()):     # one number a period
        dealt.where(F.col("drop") == drop).drop("drop").write.mode("append").parquet(source)
        query = folded.start(spark.readStream.schema(events.schema).parquet(source), checkpoint)
        query.awaitTermination()
    return folded


def q_stream_windows(spark, d):
    """Events and cents by type and sliding day, by what became of them in the stream."""
    w = _replayed(spark, d, EventWindows(scratch_path(spark, "windows"), ["event_type"], "t",
                                         {"n_events": ("count", "event_id"), "cents": ("sum", "cents")},
                                         WINDOW, DELAY, SLIDE))
    return (w.closed(spark).withColumn("fate", F.lit("closed"))
            .unionByName(w.open(spark).withColumn("fate", F.lit("open")))
            .unionByName(w.late(spark).withColumn("fate", F.lit("late"))))


def q_stream_sessions(spark, d):
    """Sessions of users as the stream finds them, and the late events."""
    s = _replayed(spark, d, EventSessions(scratch_path(spark, "sessions"), ["user_id"], "t", SESSION_GAP, DELAY))
    late = s.late(spark).select("user_id", F.col("event_time").alias("session_start"),
                                F.col("event_time").alias("session_end"), F.col("n_late").alias("n_events"),
                                F.lit("late").alias("fate"))
    return (s.closed(spark).withColumn("fate", F.lit("closed"))
            .unionByName(s.open(spark).withColumn("fate", F.lit("open"))).unionByName(late))


QUERIES = {
    "asof_last_click": q_asof_last_click,
    "asof_next_purchase": q_asof_next_purchase,
    "running_user_totals": q_running_user_totals,
    "user_sessions": q_user_sessions,
    "price_percentiles": q_price_percentiles,
    "purchases_after_clicks": q_purchases_after_clicks,
    "session_overlaps": q_session_overlaps,
    "sales_cube": q_sales_cube,
    "sales_rollup": q_sales_rollup,
    "price_percentile_sketch": q_price_percentile_sketch,
    "stream_windows": q_stream_windows,
    "stream_sessions": q_stream_sessions,
}

_E = ("(SELECT user_id, epoch_us(ts) AS t, event_id, event_type, "
      "CAST(round(value * 100) AS BIGINT) AS cents FROM events)")


def _sessions(where: str = "TRUE") -> str:
    return (f"(SELECT user_id, min(t) AS session_start, max(t) AS session_end, count(*) AS n_events FROM ("
            f"SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS s FROM (SELECT user_id, t, "
            f"CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= {SESSION_GAP} THEN 0 ELSE 1 END "
            f"AS opens FROM {_E} WHERE {where})) GROUP BY user_id, s)")


# the arrivals with the watermark of their batch, and the last watermark
_ARRIVED = f"""a AS (SELECT *, (t + CASE WHEN event_id % {ONE_IN} = 0 THEN {UNDER_WAY} ELSE 0 END) // {PERIOD} AS b
  FROM {_E}), m AS (SELECT b, max(max(t)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - {DELAY} AS mark FROM a GROUP BY b), r AS (SELECT a.*, coalesce(mark, -9000000000000000000) AS mark
  FROM a JOIN m USING (b)), z AS (SELECT max(t) - {DELAY} AS last FROM a)"""
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_SHIFT = f"greatest(0, length(bin(abs(c))) - {SKETCH_BITS + 1})"
_LOW = ", ".join(f"max(CASE WHEN r = greatest(1, ceil(CAST({q} AS DOUBLE) * m)) THEN "
                 f"sign(c) * ((abs(c) >> {_SHIFT}) << {_SHIFT}) END)::BIGINT AS {n}" for n, q in QUANTILES.items())
_PLACE = ", ".join(f"max(CASE WHEN r = greatest(1, ceil(CAST({q} AS DOUBLE) * m)) THEN price END) AS {n}"
                   for n, q in QUANTILES.items())
_SALES = ("(SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, "
          "CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)")

SQL = {
    "asof_last_click": f"""
SELECT p.event_id, c.event_id AS click_id, p.t - c.t AS waited
FROM (SELECT * FROM {_E} WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, t, max(event_id) AS event_id FROM {_E} WHERE event_type = 'click' GROUP BY ALL) c
  ON p.user_id = c.user_id AND p.t >= c.t""",
    "asof_next_purchase": f"""
SELECT c.event_id, CASE WHEN p.t <= c.t + {REACH} THEN p.v.event_id END AS purchase_id,
  CASE WHEN p.t <= c.t + {REACH} THEN p.v.cents END AS bought_cents
FROM (SELECT * FROM {_E} WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT user_id, t, max({{'event_id': event_id, 'cents': cents}}) AS v FROM {_E}
  WHERE event_type = 'purchase' GROUP BY user_id, t) p
  ON c.user_id = p.user_id AND c.t < p.t""",
    "running_user_totals": f"""
SELECT event_id, CAST(sum(cents) OVER w AS BIGINT) AS total_cents, max(cents) OVER w AS most_cents,
  count(*) OVER w AS place, count(*) OVER (PARTITION BY user_id) AS of,
  lag(event_id) OVER o AS prev_id, lead(event_id) OVER o AS next_id
FROM {_E} WINDOW o AS (PARTITION BY user_id ORDER BY t, event_id),
  w AS (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)""",
    "user_sessions": f"SELECT user_id, session_start, session_end, n_events FROM {_sessions()}",
    "price_percentiles": f"""
SELECT l_returnflag, count(*) AS n, {_PLACE} FROM (SELECT l_returnflag, l_extendedprice AS price,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS r,
  count(*) OVER (PARTITION BY l_returnflag) AS m FROM lineitem WHERE l_extendedprice IS NOT NULL)
GROUP BY l_returnflag""",
    "purchases_after_clicks": f"""
SELECT c.event_id AS click_id, count(*) AS n_purchases, CAST(sum(p.cents) AS BIGINT) AS cents
FROM {_E} c JOIN {_E} p ON c.user_id = p.user_id AND p.t >= c.t AND p.t < c.t + {REACH}
WHERE c.event_type = 'click' AND p.event_type = 'purchase' GROUP BY c.event_id""",
    "session_overlaps": f"""
SELECT user_id, count(*) AS n_pairs, CAST(sum(least(a.session_end, b.session_end)
  - greatest(a.session_start, b.session_start)) AS BIGINT) AS shared
FROM {_sessions("event_type = 'click'")} a JOIN {_sessions("event_type = 'error'")} b USING (user_id)
WHERE a.session_start <= b.session_end AND b.session_start <= a.session_end GROUP BY user_id""",
    "sales_cube": f"""
SELECT o_orderstatus, o_orderpriority, order_year,
  GROUPING(o_orderstatus, o_orderpriority, order_year) AS grouping_id, CAST(sum(c) AS BIGINT) AS cents,
  count(*) AS n FROM {_SALES} GROUP BY CUBE (o_orderstatus, o_orderpriority, order_year)""",
    "sales_rollup": f"""
SELECT order_year, o_orderstatus, GROUPING(order_year, o_orderstatus) AS grouping_id,
  CAST(sum(c) AS BIGINT) AS cents, count(*) AS n FROM {_SALES} GROUP BY ROLLUP (order_year, o_orderstatus)""",
    "price_percentile_sketch": f"""
SELECT l_returnflag, count(*) AS n, {_LOW} FROM (SELECT l_returnflag, {_CENTS} AS c,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY {_CENTS}) AS r,
  count(*) OVER (PARTITION BY l_returnflag) AS m FROM lineitem WHERE l_extendedprice IS NOT NULL)
GROUP BY l_returnflag""",
    "stream_windows": f"""
WITH {_ARRIVED}, w AS (SELECT *, t - t % {SLIDE} - k * {SLIDE} AS window_start
  FROM r, range({WINDOW // SLIDE}) AS s(k))
SELECT event_type, window_start, count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS cents,
  CASE WHEN window_start + {WINDOW} <= mark THEN 'late' WHEN window_start + {WINDOW} <= last THEN 'closed'
    ELSE 'open' END AS fate
FROM w, z GROUP BY event_type, window_start, fate""",
    "stream_sessions": f"""
WITH {_ARRIVED}
SELECT user_id, min(t) AS session_start, max(t) AS session_end, count(*) AS n_events,
  CASE WHEN max(t) + {SESSION_GAP} < max(last) THEN 'closed' ELSE 'open' END AS fate
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS s FROM (SELECT user_id, t,
  CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= {SESSION_GAP} THEN 0 ELSE 1 END AS opens
  FROM r WHERE t >= mark)), z GROUP BY user_id, s
UNION ALL SELECT user_id, t, t, count(*), 'late' FROM r WHERE t < mark GROUP BY user_id, t""",
}
