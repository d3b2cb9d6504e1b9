"""W1 live — progress per category as keyed state with timers.

Each category's latest report lives in a state store (RocksDB).  A report sets a
timer; when the clock passes it without a newer report, the category turns stale
and says so in a row of its own, though nothing came in.  Two clocks:

* ``"event"``: the watermark, i.e. the latest report of any category less
  ``late``; a replay gives the same rows as a batch run over the same reports.
  Reports that come in more than ``late`` behind it are dropped by Spark.
* ``"arrival"``: the wall clock since the last report came in; none is dropped.

Reports are combined to one row per category and Arrow batch before the shuffle,
so a category that holds most of them does not make a long task.  A row's fields
follow ``progress.py``: the count and the status given last, the latest heartbeat.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from docweave.session import path_exists
from docweave.streaming.progress import IDLE, STALE_AFTER_SECONDS

# The processor's code is shipped with the task (pickled by value).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# Built by hand: a worker has no session to parse a schema with.
_FIELDS = [("count", T.LongType()), ("count_at", T.LongType()), ("count_tie", T.LongType()), ("status", T.StringType()),
           ("status_at", T.LongType()), ("status_tie", T.LongType()), ("heartbeat", T.LongType())]
_LATEST = T.StructType([T.StructField(n, t) for n, t in [*_FIELDS, ("version", T.LongType())]])
_NEWEST = T.StructType([T.StructField(n, t) for n, t in [("category", T.StringType()), *_FIELDS]])
_CHANGE = "category string, count long, status string, heartbeat_us long, stale boolean, version long"


def _newest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per category and batch: the newest count, status and heartbeat."""
    for frame in frames:
        frame = frame.sort_values(["at", "tie"], kind="stable")
        frame["count_at"], frame["count_tie"] = frame["at"].where(frame["count"].notna()), frame["tie"].where(frame["count"].notna())
        frame["status_at"], frame["status_tie"] = frame["at"].where(frame["status"].notna()), frame["tie"].where(frame["status"].notna())
        frame["heartbeat"] = frame["at"]
        fields = [n for n, _ in _FIELDS]
        # last() skips nulls: of each field the newest given value
        out = frame.groupby("category", sort=False)[fields].last().reset_index()
        yield out.astype({f: "Int64" for f in fields if f != "status"})


class _Progress(StatefulProcessor):
    def __init__(self, stale_after: float, by_event: bool):
        self.stale_us, self.by_event = round(stale_after * 1_000_000), by_event

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", _LATEST)

    def _change(self, category: str, latest: tuple, stale: bool) -> Row:
        return Row(category=category, count=latest[0], status=latest[3], heartbeat_us=latest[6], stale=stale, version=latest[7])

    def _keep(self, latest: list) -> tuple:
        latest[7] += 1
        self.latest.update(tuple(latest))
        return tuple(latest)

    def handleInputRows(self, key, rows, timerValues):
        latest = list(self.latest.get() or (None,) * 7 + (0,))
        for r in rows:
            for value, at, tie in ((0, 1, 2), (3, 4, 5)):
                if r[at + 1] is not None and (latest[at] is None or (r[at + 1], r[tie + 1]) > (latest[at], latest[tie])):
                    latest[value], latest[at], latest[tie] = r[value + 1], r[at + 1], r[tie + 1]
            latest[6] = max(latest[6] if latest[6] is not None else r.heartbeat, r.heartbeat)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self.by_event:
            # the first millisecond that is more than the allowance after the heartbeat
            self.handle.registerTimer((latest[6] + self.stale_us) // 1000 + 1)
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stale_us // 1000 + 1)
        yield self._change(key[0], self._keep(latest), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._change(key[0], self._keep(list(self.latest.get())), True)

    def close(self) -> None:
        pass


def start_live_progress(reports: DataFrame, log: str, checkpoint: str, category: str = "category", ts: str = "ts", status: str = "status",
                        count: str = "count", tie: str = "event_id", stale_after: float = STALE_AFTER_SECONDS, clock: str = "event",
                        late: str = "0 seconds", trigger: dict | None = None):
    """Start the query over the stream ``reports``; the ``StreamingQuery``.

    Every micro-batch writes the categories that changed into a folder of its own
    under ``log`` (a batch that runs again replaces it).  ``ts`` may have a time
    zone or not; ``count`` and ``tie`` are cast to long; reports without a
    category or a time are left out."""
    if clock not in ("event", "arrival"):
        raise ValueError(f"clock is 'event' or 'arrival', not {clock!r}")
    spark = reports.sparkSession
    zoned = isinstance(reports.schema[ts].dataType, T.TimestampType)
    at = F.unix_micros(F.col(ts)) if zoned else F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{ts}`)")
    narrow = reports.select(F.col(category).cast("string").alias("category"), at.alias("at"), F.coalesce(F.col(tie).cast("long"), F.lit(0)).alias("tie"),
                            F.col(status).cast("string").alias("status"), F.col(count).cast("long").alias("count"))
    narrow = narrow.where("category IS NOT NULL AND at IS NOT NULL")
    newest = narrow.mapInPandas(_newest, _NEWEST)
    if clock == "event":
        newest = newest.withColumn("event_time", F.timestamp_micros("heartbeat")).withWatermark("event_time", late)
    changes = newest.groupBy("category").transformWithState(
        _Progress(stale_after, clock == "event"), _CHANGE, "Update", "EventTime" if clock == "event" else "ProcessingTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    # Timers need a state store with column families; the query keeps the
    # setting that it starts with.
    name, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, rocks)
    try:
        return (changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def live_progress(spark: SparkSession, log: str, categories: DataFrame) -> DataFrame:
    """The state of every category of the list as of the last micro-batch:
    ``category, count, status, heartbeat, stale, last_update``; one that never
    reported shows 0, ``Idle`` and ``-``."""
    changes = spark.createDataFrame([], _CHANGE)
    if path_exists(spark, log):
        changes = spark.read.schema(_CHANGE).option("basePath", log).parquet(f"{log}/batch=*")
    fields = F.struct("count", "status", "heartbeat_us", "stale")
    latest = changes.groupBy("category").agg(F.max_by(fields, "version").alias("l"))
    heartbeat = F.expr(f"timestampadd(MICROSECOND, l.heartbeat_us, {_EPOCH})")
    return categories.select("category").distinct().join(latest, "category", "left").select(
        "category", F.coalesce("l.count", F.lit(0)).alias("count"), F.coalesce("l.status", F.lit(IDLE)).alias("status"), heartbeat.alias("heartbeat"),
        F.coalesce("l.stale", F.lit(False)).alias("stale"),
        F.coalesce(F.date_format(heartbeat, "yyyy-MM-dd HH:mm:ss"), F.lit("-")).alias("last_update"))
