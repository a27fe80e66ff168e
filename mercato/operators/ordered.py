"""Running aggregates in a global order without a single-task window.

Rows are dealt into ranges of the order column; the running aggregate runs per range in parallel
and a prefix table over the ranges (one row each) carries what all earlier ranges contributed.
Results are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranges import in_ranges


def running_max_before(df: DataFrame, order: str, value: str, buckets: int | None = None) -> DataFrame:
    """``max(value)`` over all rows strictly earlier in ``order`` (null for the first).  ``buckets``, the number of
    ranges, is the session's number of shuffle partitions unless given."""
    x = in_ranges(df, [order], buckets)
    per = x.groupBy("_r").agg(F.max(value).alias("_bm"))
    prev = per.select("_r", F.max("_bm").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
                      .alias("_prev"))
    w = Window.partitionBy("_r").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    y = x.join(F.broadcast(prev), "_r")  # one row per range: bounded by the number of partitions
    return y.withColumn("seen_max", F.greatest(F.max(value).over(w), F.col("_prev"))).drop("_r", "_prev")


def late_rows(events: DataFrame, arrival: str = "event_id", ts: str = "ts", delay_minutes: int = 10,
              buckets: int | None = None) -> DataFrame:
    """Rows whose event time is older than (latest event time already seen -
    delay) when they arrive: what a watermark of that delay would drop."""
    r = running_max_before(events.select(arrival, ts, "event_type"), arrival, ts, buckets)
    late = F.col(ts) < F.col("seen_max") - F.expr(f"INTERVAL {delay_minutes} MINUTES")
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(late).alias("n_late"))
