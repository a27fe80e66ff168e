"""Streaming plans: each runs the stream to completion with
``availableNow`` and returns its final image; the SQL oracle is the batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mercato.plans.registry import register
from mercato.session import scratch_path
from mercato.streaming import jobs as J


@register("stream_hourly_windows", "L1+L2+L3+L4+L5", sql="""
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS n, round(SUM(value), 4) AS value
FROM (SELECT DISTINCT ON (event_id) * FROM events) GROUP BY 1, 2""")
def stream_hourly_windows(spark, sf):
    s = J.deduplicated(J.events_stream(spark, sf))
    return J.run_upsert_stream(J.hourly_windows(s), "hourly", ["window_start", "event_type"])


@register("stream_sliding_trend", "L9", sql="""
WITH w AS (SELECT date_trunc('day', ts) - k * INTERVAL 1 DAY AS window_start, event_type, value
           FROM events, (SELECT unnest(range(0, 7)) AS k))
SELECT window_start, event_type, COUNT(*) AS n, round(AVG(value), 6) AS mean_value FROM w GROUP BY 1, 2""")
def stream_sliding_trend(spark, sf):
    s = J.events_stream(spark, sf).withWatermark("ts", "1 day")
    return J.run_upsert_stream(J.sliding_trend(s), "sliding", ["window_start", "event_type"])


@register("stream_user_state", "L6")
def stream_user_state(spark, sf):
    s = J.user_state_stream(J.events_stream(spark, sf))
    return J.run_upsert_stream(s, "user_state", ["user_id"])


@register("user_state_batch_twin", "L6+L8", sql="""
SELECT user_id, COUNT(*) AS n, MIN(ts) AS first_seen, MAX(ts) AS last_seen, arg_max(value, ts) AS last_value
FROM events GROUP BY user_id""")
def user_state_batch_twin(spark, sf):
    return J.user_state_batch(J.events_batch(spark, sf))


@register("backfill_hourly_windows", "L8", sql="""
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS n, round(SUM(value), 4) AS value
FROM (SELECT DISTINCT ON (event_id) * FROM events) GROUP BY 1, 2""")
def backfill_hourly_windows(spark, sf):
    """Backfill from the raw layer: the stream's transform on a batch read."""
    return J.hourly_windows(J.deduplicated(J.events_batch(spark, sf), streaming=False))


@register("stream_fan_out", "L7", sql="""
SELECT 'items' AS "table", COUNT(*) AS n FROM events
UNION ALL SELECT 'users', COUNT(*) FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT 'actions', SUM(k)::BIGINT FROM (SELECT COUNT(*) AS k FROM events GROUP BY event_type)""")
def stream_fan_out(spark, sf):
    return J.fan_out(J.events_stream(spark, sf), "fanout").select("table", F.col("n").cast("bigint").alias("n"))


@register("late_rows_by_watermark", "L3", sql="""
WITH r AS (SELECT event_type, ts,
                  MAX(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
           FROM events)
SELECT event_type, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ts < seen - INTERVAL 10 MINUTE) AS n_late
FROM r GROUP BY event_type""")
def late_rows_by_watermark(spark, sf):
    """Batch twin of the watermark: rows that arrive (in event-id order) more
    than 10 minutes behind the latest event time already seen."""
    from mercato.operators.ordered import late_rows
    return late_rows(J.events_batch(spark, sf), "event_id", "ts", 10)


LANDED_SQL = """
WITH d AS (SELECT *, substr(md5(CAST(event_id AS VARCHAR)), 1, 1) AS digit FROM events),
a AS (SELECT event_id, event_type, ts, value, unnest(CASE WHEN digit IN ('0', '1') THEN [ts + INTERVAL 24 HOUR]
        WHEN digit = '2' THEN [ts, ts + INTERVAL 24 HOUR] ELSE [ts] END) AS arrival FROM d),
b AS (SELECT epoch_us(MIN(ts)) AS lo, epoch_us(MAX(ts) + INTERVAL 24 HOUR) AS hi FROM events),
c AS (SELECT a.*, LEAST(CAST(floor((epoch_us(arrival) - lo) * 8 / (hi - lo)) AS INTEGER), 7) AS chunk FROM a, b),
m AS (SELECT chunk, MAX(MAX(ts)) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM c GROUP BY chunk),
r AS (SELECT c.*, COALESCE(c.ts < m.seen - INTERVAL 10 MINUTE, FALSE) AS late FROM c JOIN m USING (chunk))"""


@register("stream_late_rows", "L3+L4", sql=LANDED_SQL + """
SELECT event_type, chunk AS epoch, late, COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_events FROM r GROUP BY ALL""")
def stream_late_rows(spark, sf):
    """Events landed out of order, some late and some twice, pulled in eight micro-batches: no row is dropped, late
    ones are in a side table."""
    on_time, late = _landed(spark, sf)
    rows = on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return rows.groupBy("event_type", "epoch", "late").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_events"))


@register("stream_on_time_windows", "L2+L3+L4", sql=LANDED_SQL + """
, first AS (SELECT DISTINCT event_id, event_type, ts, value, 0 AS late FROM r WHERE NOT late),
 news AS (SELECT DISTINCT event_id, event_type, ts, value, 1 AS late FROM r WHERE late AND event_id NOT IN (SELECT event_id FROM first))
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) FILTER (WHERE late = 0) AS n,
       round(COALESCE(SUM(value) FILTER (WHERE late = 0), 0.0), 4) AS value, COUNT(*) FILTER (WHERE late = 1) AS n_late
FROM (SELECT * FROM first UNION ALL SELECT * FROM news) GROUP BY 1, 2""")
def stream_on_time_windows(spark, sf):
    """Hourly windows of what came in time, each event once, and how many late events were new to a window."""
    return J.on_time_windows(*_landed(spark, sf))


def _landed(spark, sf):
    events = J.events_batch(spark, sf)
    folders = J.out_of_order(events, scratch_path(spark, f"landed/{uuid.uuid4().hex}"))
    return J.keep_late_rows(spark, folders, events.schema, "late")
