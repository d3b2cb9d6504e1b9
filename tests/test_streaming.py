import tempfile
import time

from pyspark.sql import functions as F

from docweave.operators.extract import extract_entities
from docweave.operators.shred import shred
from docweave.sources.published import PublishedTables
from docweave.streaming.incremental import run_incremental
from docweave.streaming.progress import category_progress, progress_stream


def test_incremental_equals_batch_and_resumes(spark):
    base = tempfile.mkdtemp(prefix="dw-stream-", dir="/tmp")
    rows = [("t", f"P{i}/index.html", f"<h1>class C{i}</h1>") for i in range(30)]
    pages = spark.createDataFrame(rows, "category string, source_path string, html string")
    pages.filter("source_path < 'P2'").coalesce(1).write.mode("append").parquet(f"{base}/src")
    out = run_incremental(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    assert out.count() == 12  # P0, P1, P10..P19
    # new files arrive: only they are processed on the next run
    pages.filter("source_path >= 'P2'").coalesce(2).write.mode("append").parquet(f"{base}/src")
    out = run_incremental(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    batch = extract_entities(shred(pages, keep=["category", "source_path"], spread=False))
    assert sorted(r.source_path for r in out.collect()) == sorted(r.source_path for r in batch.collect())


def test_incremental_result_does_not_depend_on_the_batch_size(spark):
    base = tempfile.mkdtemp(prefix="dw-stream-", dir="/tmp")
    rows = [("d", "X/index.html"), ("r", "X/index.html"), ("d", "a/b"), ("d", "a__b"), ("d", "X/index.html"), ("d", "Y"), ("d", "a/b")]
    for i, (c, p) in enumerate(rows):
        spark.createDataFrame([(c, p, f"<h1>class {c}{p}</h1>")], "category string, source_path string, html string").coalesce(1).write.mode("append").parquet(f"{base}/src")
    want = sorted(set(rows))
    for n in (1, 3, None):
        out = run_incremental(spark, f"{base}/src", f"{base}/out{n}", f"{base}/ckpt{n}", n)
        assert sorted((r.category, r.source_path) for r in out.collect()) == want
    assert max(PublishedTables(spark, f"{base}/out1").manifest()["streams"].values()) >= 2  # three batches or more
    # a new checkpoint counts its batches from 0: pages seen are skipped, others are not
    spark.createDataFrame([("d", "Z", "<h1>class Z</h1>")], "category string, source_path string, html string").write.mode("append").parquet(f"{base}/src")
    out = run_incremental(spark, f"{base}/src", f"{base}/outNone", f"{base}/other")
    assert sorted((r.category, r.source_path) for r in out.collect()) == sorted([*want, ("d", "Z")])


def test_new_pages_are_picked_without_dealing_pages(spark, monkeypatch):
    from docweave.streaming import incremental as I

    base = tempfile.mkdtemp(prefix="dw-stream-", dir="/tmp")
    rows = [("t", f"P{i}", "x" * 50) for i in range(70_000)]    # three blocks of rows to a file
    spark.createDataFrame(rows, "category string, source_path string, html string").coalesce(1).write.parquet(f"{base}/src")
    spark.createDataFrame(rows[:10], "category string, source_path string, html string").coalesce(1).write.mode("append").parquet(f"{base}/src")
    batch = spark.read.parquet(f"{base}/src").select("*", F.col("_metadata.file_path").alias("from_file"), F.col("_metadata.row_index").alias("from_row"))
    new = batch.filter(F.pmod(F.xxhash64("from_file", "from_row"), F.lit(3)) == 0).select("from_file", "from_row")
    want = sorted(r.source_path for r in batch.join(new, ["from_file", "from_row"], "left_semi").collect())
    assert len(want) > 20_000
    places = I._bitmaps(new)
    assert places.count() <= 4
    pages = I._at(batch, new, places)
    assert pages.columns == ["category", "source_path", "html"]
    assert sorted(r.source_path for r in pages.collect()) == want
    plan = pages._jdf.queryExecution().optimizedPlan().toString() + pages._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(I, "MOST_BITMAPS", 0)
    assert sorted(r.source_path for r in I._at(batch, new, places).collect()) == want


def test_progress_semantics(spark):
    ev = spark.createDataFrame([("a", 1, 5, "Extracting", 0), ("a", 2, 9, None, 1), ("b", 40, None, None, 2), ("a", 2, 7, None, 0)],
                               "category string, t int, count long, status string, event_id long")
    ev = ev.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    cats = spark.createDataFrame([("a",), ("b",), ("c",)], "category string")
    got = {r.category: (r["count"], r.status, r.stale, r.last_update) for r in category_progress(ev, cats).collect()}
    assert got == {"a": (9, "Extracting", True, "1970-01-01 00:00:02"), "b": (0, "Idle", False, "1970-01-01 00:00:40"), "c": (0, "Idle", False, "-")}


def test_progress_batch_and_stream(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cats = ev.select(F.col("event_type").alias("category")).distinct()
    batch = {r.category: r for r in category_progress(ev, cats, category="event_type", status="user_id", count="value").collect()}
    d = tempfile.mkdtemp(prefix="dw-prog-", dir="/tmp")
    ev.write.parquet(f"{d}/in")
    q = progress_stream(spark, f"{d}/in", ev.schema, query_name="progress_test", checkpoint=f"{d}/ck")
    q.processAllAvailable()
    live = {r.event_type: r for r in spark.sql("SELECT * FROM progress_test").collect()}
    q.stop()
    assert set(live) == set(batch)
    for k in batch:
        assert live[k]["count"] == batch[k]["count"] and live[k]["heartbeat"] == batch[k]["heartbeat"]
    assert any(r.stale for r in batch.values()) or all(r.age_seconds <= 30 for r in batch.values())
