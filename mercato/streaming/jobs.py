"""Structured Streaming jobs over the item/event stream, each with a batch twin.

Every transform is a function of a DataFrame, so the same code runs on
``readStream`` (incremental) and on ``read`` (backfill / batch twin).  Sinks go
through ``foreachBatch`` and write one folder per epoch with overwrite: a
replayed epoch rewrites the same folder, so the sink is idempotent; the final
image keeps the newest epoch per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from mercato.operators.relational import latest_per_key
from mercato.session import scratch_path
from mercato.sources.tables import SCHEMAS


def events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """File-source stream of the events table, one file or a folder of files (schema fixed, bounded chunks).

    The path is a pattern that matches this one name: a stream's plain path must be a folder."""
    return (spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", max_files)
            .parquet(f"{sf_dir}/events.parque[t]"))


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet")


def deduplicated(df: DataFrame, delay: str = "10 minutes", streaming: bool = True) -> DataFrame:
    """Watermark on event time and duplicate suppression by event id."""
    if streaming:
        return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return df.dropDuplicates(["event_id"])


def hourly_windows(df: DataFrame) -> DataFrame:
    """Tumbling one-hour windows per event type."""
    g = df.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "value")


def sliding_trend(df: DataFrame) -> DataFrame:
    """Seven-day windows sliding by one day: mean value per event type."""
    g = df.groupBy(F.window("ts", "7 days", "1 day").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", "mean_value")


def run_upsert_stream(agg: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Run an aggregating stream to completion (``availableNow``) through an
    epoch-keyed ``foreachBatch`` sink and return the final image."""
    spark = agg.sparkSession
    run = uuid.uuid4().hex
    out = scratch_path(spark, f"streams/{name}/{run}/data")
    ckpt = scratch_path(spark, f"streams/{name}/{run}/checkpoint")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_per_key(spark.read.parquet(out), list(keys), ["epoch"]).drop("epoch")


STATE_SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("first_ts", T.TimestampType()),
                             T.StructField("last_ts", T.TimestampType()), T.StructField("last_value", T.DoubleType())])
USER_OUT_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("n", T.LongType()),
                                T.StructField("first_seen", T.TimestampType()),
                                T.StructField("last_seen", T.TimestampType()),
                                T.StructField("last_value", T.DoubleType()),
                                T.StructField("silent", T.BooleanType())])


def _user_state(key, pdfs, state):
    """Per-user running state: count, first/last seen, value at the last event.
    On event-time timeout (no event for the silence period) the user is
    reported as silent (the item-sold signal)."""
    if state.hasTimedOut:
        n, first, last, value = state.get
        state.remove()
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "first_seen": [first], "last_seen": [last],
                            "last_value": [value], "silent": [True]})
        return
    n, first, last, value = state.get if state.exists else (0, None, None, None)
    for pdf in pdfs:
        if pdf.empty:
            continue
        n += len(pdf)
        lo, i_hi = pdf["ts"].min(), pdf["ts"].idxmax()
        hi = pdf["ts"].loc[i_hi]
        first = lo if first is None or lo < first else first
        if last is None or hi > last:
            last, value = hi, float(pdf["value"].loc[i_hi])
    state.update((n, first, last, value))
    state.setTimeoutTimestamp(int(pd.Timestamp(last).timestamp() * 1000) + 24 * 3600 * 1000)
    yield pd.DataFrame({"user_id": [key[0]], "n": [n], "first_seen": [first], "last_seen": [last],
                        "last_value": [value], "silent": [False]})


def user_state_stream(events: DataFrame) -> DataFrame:
    return (events.withWatermark("ts", "1 hour").groupBy("user_id")
            .applyInPandasWithState(_user_state, USER_OUT_SCHEMA, STATE_SCHEMA, "update",
                                    GroupStateTimeout.EventTimeTimeout))


def user_state_batch(events: DataFrame) -> DataFrame:
    """Batch twin of the per-user state."""
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.max_by("value", "ts").alias("last_value"))


def fan_out(events: DataFrame, name: str) -> DataFrame:
    """One stream fanned out into three tables per micro-batch (items, users,
    actions), the batch cached once; returns row counts per table."""
    spark = events.sparkSession
    run = uuid.uuid4().hex
    base = scratch_path(spark, f"streams/{name}/{run}")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        batch.select("event_id", "ts", "user_id", "value").write.mode("overwrite").parquet(
            f"{base}/items/epoch={epoch_id}")
        batch.select("user_id").distinct().write.mode("overwrite").parquet(f"{base}/users/epoch={epoch_id}")
        batch.groupBy("event_type").count().write.mode("overwrite").parquet(f"{base}/actions/epoch={epoch_id}")
        batch.unpersist()

    q = (events.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    items = spark.read.parquet(f"{base}/items").agg(F.count(F.lit(1)).alias("n")).withColumn("table", F.lit("items"))
    users = (spark.read.parquet(f"{base}/users").select("user_id").distinct().agg(F.count(F.lit(1)).alias("n"))
             .withColumn("table", F.lit("users")))
    acts = (spark.read.parquet(f"{base}/actions").agg(F.sum("count").alias("n"))
            .withColumn("table", F.lit("actions")))
    return items.unionByName(users).unionByName(acts)


def out_of_order(events: DataFrame, path: str, chunks: int = 8, delay_hours: int = 24) -> list[str]:
    """Land the events in ``chunks`` folders by time of arrival, an input with late and repeated rows: an event whose
    id's digest starts with 0 or 1 arrives ``delay_hours`` late, and one whose digest starts with 2 arrives again then."""
    digit = F.substring(F.md5(F.col("event_id").cast("string")), 1, 1)
    hours = F.expr(f"INTERVAL {delay_hours} HOURS")
    arrivals = F.when(digit.isin("0", "1"), F.array(F.col("ts") + hours)).when(
        digit == "2", F.array(F.col("ts"), F.col("ts") + hours)).otherwise(F.array(F.col("ts")))
    rows = events.withColumn("_at", F.explode(arrivals))
    lo, hi = events.select(F.min("ts")).scalar(), events.select(F.max("ts") + hours).scalar()
    at, lo, hi = (F.unix_micros(c) for c in (F.col("_at"), lo, hi))
    chunk = F.least(F.floor((at - lo) * F.lit(chunks) / (hi - lo)).cast("int"), F.lit(chunks - 1))
    rows.withColumn("_chunk", chunk).repartition("_chunk", F.pmod(F.xxhash64("event_id"), F.lit(8))).drop("_at").write.partitionBy(
        "_chunk").parquet(path)
    return [f"{path}/_chunk={i}" for i in range(chunks)]


def keep_late_rows(spark: SparkSession, landed: Sequence[str], schema: T.StructType, name: str, delay: str = "10 minutes",
                   fail_after: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Pull each landed folder as one micro-batch and split it by the watermark; nothing is dropped.

    The watermark of an epoch is the latest event time of all earlier epochs less ``delay``; it is read from what
    those epochs wrote, so a replayed epoch splits alike.  Rows before it go to a side table, others to the
    result, each in a folder per epoch that a replay overwrites.  Returns (on time, late).

    ``fail_after`` names a step after which the first epoch fails once (tests of replay)."""
    base = scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex}")
    failing = {"left": 1 if fail_after else 0}

    def crash(step: str) -> None:
        if failing["left"] and step == fail_after:
            failing["left"] = 0
            raise RuntimeError(f"lost after {step}")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        seen = None
        if epoch_id:
            seen = batch.sparkSession.read.schema("epoch int, latest timestamp").parquet(f"{base}/seen").filter(
                F.col("epoch") < epoch_id).agg(F.max("latest")).first()[0]
        mark = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col("ts") < mark, F.lit(False))
        batch.filter(late).write.mode("overwrite").parquet(f"{base}/late/epoch={epoch_id}")
        crash("late")
        batch.filter(~late).write.mode("overwrite").parquet(f"{base}/on_time/epoch={epoch_id}")
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{base}/seen/epoch={epoch_id}")
        crash("seen")

    def pull(at: int) -> None:
        # one query per landed folder, as a scheduled pull runs it; epochs go on from folder to folder
        source = spark.readStream.schema(schema).parquet(landed[at])
        (source.writeStream.foreachBatch(lambda b, _: sink(b, at)).option("checkpointLocation", f"{base}/checkpoint/{at}")
         .trigger(availableNow=True).start().awaitTermination())

    for i in range(len(landed)):
        try:
            pull(i)
        except StreamingQueryException:  # the same epoch again; a second failure is raised
            if fail_after is None:
                raise
            pull(i)
    full = T.StructType([*schema.fields, T.StructField("epoch", T.IntegerType())])
    return spark.read.schema(full).parquet(f"{base}/on_time"), spark.read.schema(full).parquet(f"{base}/late")


def on_time_windows(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Hourly windows of the events that came in time (each event once, however often it arrived), and beside them
    how many of the late ones were new to the window."""
    first = on_time.groupBy("event_id", "event_type", "ts").agg(F.min("value").alias("value")).withColumn("_late", F.lit(0))
    new = late.select("event_id", "event_type", "ts", "value").distinct().join(first.select("event_id"), "event_id", "left_anti")
    both = first.unionByName(new.withColumn("_late", F.lit(1)).select(*first.columns))
    return both.groupBy(F.date_trunc("hour", "ts").alias("window_start"), "event_type").agg(
        F.count_if(F.col("_late") == 0).alias("n"), F.round(F.coalesce(F.sum(F.when(F.col("_late") == 0, F.col("value"))), F.lit(0.0)), 4).alias("value"),
        F.count_if(F.col("_late") == 1).alias("n_late"))
