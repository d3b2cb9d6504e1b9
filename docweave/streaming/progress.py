"""W1 — live progress per category: latest count, status and heartbeat, and
whether the heartbeat is stale (older than 30 s at the as-of time).

The count is the one reported last, the status the last one that was given (a
report without one keeps it; ``Idle`` before any).  A category of the list that
never reported shows count 0, ``Idle`` and ``-``.

Batch form: one partial+final aggregate per category (``max_by`` for the latest
value) and one scalar ``max`` for the as-of time.  Streaming form: the same
aggregate over an unbounded source; state is one row per category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a heartbeat older than this is stale.
STALE_AFTER_SECONDS = 30


#: Fixed value: the status before any is reported.
IDLE = "Idle"


def _progress_aggs(ts: str, status: str, count: str, tie: str) -> list[Column]:
    at = F.struct(F.col(ts), F.col(tie))
    return [
        F.max_by(F.col(count), F.when(F.col(count).isNotNull(), at)).alias("count"),
        F.max_by(F.col(status), F.when(F.col(status).isNotNull(), at)).alias("status"),
        F.max(F.col(ts)).alias("heartbeat"),
    ]


def category_progress(events: DataFrame, categories: DataFrame, category: str = "category", ts: str = "ts", status: str = "status",
                      count: str = "count", tie: str = "event_id", stale_after: int = STALE_AFTER_SECONDS) -> DataFrame:
    """Batch W1 of the listed ``categories (category)``, with the as-of time =
    the latest heartbeat of any of them.

    The as-of time is the max over the per-category rows (one row per
    category, so that last window has nothing to shuffle that grows with the
    events)."""
    latest = events.groupBy(F.col(category).alias("category")).agg(*_progress_aggs(ts, status, count, tie))
    latest = categories.select("category").distinct().join(latest, "category", "left")
    latest = latest.withColumn("as_of", F.max("heartbeat").over(Window.partitionBy()))
    # timestamp differences on the stored values: no session time zone involved
    age = F.expr("timestampdiff(MICROSECOND, heartbeat, as_of)") / 1_000_000
    return latest.select(
        "category", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce(F.col("status").cast("string"), F.lit(IDLE)).alias("status"), "heartbeat",
        age.cast("double").alias("age_seconds"), F.coalesce(age > stale_after, F.lit(False)).alias("stale"),
        # a category that never reported shows '-'
        F.when(F.col("heartbeat").isNull(), F.lit("-")).otherwise(F.date_format(F.col("heartbeat").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")).alias("last_update"),
    )


def progress_stream(spark, source_dir: str, schema, category: str = "event_type", ts: str = "ts",
                    status: str = "user_id", count: str = "value", tie: str = "event_id", query_name: str = "progress",
                    checkpoint: str | None = None):
    """Streaming W1: parquet files arriving in ``source_dir`` → an in-memory
    table ``query_name`` holding the latest progress row per category."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    agg = stream.groupBy(category).agg(*_progress_aggs(ts, status, count, tie))
    w = agg.writeStream.outputMode("complete").format("memory").queryName(query_name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def progress_to_table(spark, source_glob: str, schema, out_path: str, checkpoint: str, reports=None, category: str = "category",
                      ts: str = "ts", status: str = "status", count: str = "count", tie: str = "event_id"):
    """Streaming W1 into a table: the complete per-category state is written
    (overwrite) after every micro-batch; ``availableNow`` drains what is there
    and stops.  The state store holds one row per category.  ``reports`` turns
    the source's rows into reports."""
    stream = spark.readStream.schema(schema).parquet(source_glob)
    stream = reports(stream) if reports else stream
    agg = stream.groupBy(category).agg(*_progress_aggs(ts, status, count, tie))

    def write(batch, _batch_id):
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
