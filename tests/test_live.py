"""W1 live: timers turn categories stale without a new report."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from docweave.streaming.live import live_progress, start_live_progress
from docweave.streaming.progress import category_progress

SCHEMA = "category string, t double, count long, status string, event_id long"


def reports(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))


def state(df):
    return {r.category: (r["count"], r.status, r.stale, r.last_update) for r in df.collect()}


def test_event_clock_equals_batch_after_every_run(spark):
    base = tempfile.mkdtemp(prefix="dw-live-", dir="/tmp")
    cats = spark.createDataFrame([(c,) for c in ("a", "b", "c", "d", "never")], "category string")
    runs = [
        [("a", 1.0, 5, "Extracting", 0), ("a", 2.0, 9, None, 1), ("a", 2.0, 7, None, 0), ("b", 3.0, None, None, 2)],
        # b reports again, a does not and turns stale; exactly 30 s are not stale
        [("b", 32.0, 1, "Done", 3), ("c", 33.0, 2, "Half", 4), ("b", 33.5, None, "Late status", 5)],
        # a comes back; c turns stale; d only ever gives a status
        [("a", 63.5, 11, None, 6), ("d", 64.0, None, "Waiting", 7), (None, 99.0, 1, "no category", 8)],
        [("a", 200.0, None, None, 9)],
    ]
    seen = []
    for n, rows in enumerate(runs):
        reports(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        seen += [r for r in rows if r[0]]
        stream = spark.readStream.schema(reports(spark, rows).schema).parquet(f"{base}/in")
        start_live_progress(stream, f"{base}/log", f"{base}/ck").awaitTermination()
        got = state(live_progress(spark, f"{base}/log", cats))
        assert got == state(category_progress(reports(spark, seen), cats)), n
        assert got["never"] == (0, "Idle", False, "-")
    assert got["b"][2] and got["c"][2] and got["d"][2] and not got["a"][2]


def test_arrival_clock_turns_stale_by_itself(spark):
    base = tempfile.mkdtemp(prefix="dw-live-", dir="/tmp")
    df = reports(spark, [("a", 1.0, 5, "Extracting", 0)])
    df.coalesce(1).write.parquet(f"{base}/in")
    cats = spark.createDataFrame([("a",)], "category string")
    q = start_live_progress(spark.readStream.schema(df.schema).parquet(f"{base}/in"), f"{base}/log", f"{base}/ck", stale_after=2.0, clock="arrival",
                            trigger={"processingTime": "500 milliseconds"})
    try:
        end, stales = time.time() + 90, []
        while time.time() < end and True not in stales:
            assert q.exception() is None
            got = state(live_progress(spark, f"{base}/log", cats))["a"]
            if got[0] == 5:
                stales.append(got[2])
            time.sleep(0.3)
    finally:
        q.stop()
    assert stales[-1] and got == (5, "Extracting", True, "1970-01-01 00:00:01")


def test_nothing_arrived(spark):
    cats = spark.createDataFrame([("a",)], "category string")
    assert state(live_progress(spark, "/tmp/no-such-log", cats)) == {"a": (0, "Idle", False, "-")}
    with pytest.raises(ValueError):
        start_live_progress(reports(spark, []), "x", "y", clock="sundial")


def test_metrics_of_every_micro_batch(spark):
    from docweave.streaming.metrics import StreamMetrics, observed

    base = tempfile.mkdtemp(prefix="dw-live-", dir="/tmp")
    spark.range(100).repartition(5).write.parquet(f"{base}/in")
    for n, run in enumerate(("first", "again")):
        metrics = StreamMetrics("ids")
        spark.streams.addListener(metrics)
        stream = observed(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in"), "ids",
                          rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
        got = metrics.totals()
        spark.streams.removeListener(metrics)
        if run == "first":
            assert got == {"rows": 100, "odd": 50} and metrics.batches >= 5
        else:  # goes on where the checkpoint ends: nothing is counted twice
            assert got.get("rows", 0) == 0
