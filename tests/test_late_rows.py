"""Late and repeated rows of a stream: kept in a side table, replayed alike, equal to the batch."""

import tempfile

import pytest
from pyspark.sql import functions as F

from mercato.streaming import jobs

SF = "/root/testdata/sf0.001"


def counts(df):
    return sorted((r["event_id"], r["epoch"]) for r in df.select("event_id", "epoch").collect())


@pytest.mark.parametrize("step", [None, "late", "seen"])
def test_stream_and_late_rows_are_the_batch(spark, step):
    events = jobs.events_batch(spark, SF)
    folders = jobs.out_of_order(events, tempfile.mkdtemp(prefix="landed-") + "/t", 8)
    landed = spark.read.schema(events.schema).parquet(*folders)
    on_time, late = jobs.keep_late_rows(spark, folders, events.schema, "late-test", fail_after=step)
    both = on_time.unionByName(late)
    assert both.count() == landed.count() > events.count()
    assert both.select(*events.columns).exceptAll(landed).count() == 0
    assert late.count() > 0 and late.select("event_id").intersect(on_time.select("event_id")).count() > 0
    # a late row is older than the watermark of its epoch, an early one is not
    seen = {r["epoch"]: r["m"] for r in both.groupBy("epoch").agg(F.max("ts").alias("m")).collect()}
    import datetime as dt
    for df, is_late in ((on_time, False), (late, True)):
        for r in df.groupBy("epoch").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect():
            earlier = [seen[e] for e in seen if e < r["epoch"]]
            mark = max(earlier) - dt.timedelta(minutes=10) if earlier else dt.datetime.min
            assert r["hi"] < mark if is_late else r["lo"] >= mark
    w = jobs.on_time_windows(on_time, late).agg(F.sum("n"), F.sum("n_late")).first()
    assert w[0] + w[1] == events.count() and w[1] > 0
