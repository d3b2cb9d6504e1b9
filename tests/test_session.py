"""The session helpers leave a running session alone."""

import os

from docweave import session


def test_existing_session_keeps_its_settings(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone"]
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert session.get_session("local[2]").conf.get("spark.sql.shuffle.partitions") == "23"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
    assert {k: spark.conf.get(k) for k in keys} == before


def test_materialized_tables_are_pruned(spark):
    df = session.materialize(spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS category", "repeat('x', 100) AS wide"), ["category"])
    plan = df.filter("category = '1'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan and "wide" not in plan.split("ReadSchema")[1]


def test_delete_path(spark):
    path = session.ensure_checkpoint_dir(spark) + "/gone"
    spark.range(1).write.parquet(path)
    assert session.path_exists(spark, path)
    session.delete_path(spark, path)
    assert not session.path_exists(spark, path) and not os.path.exists(path.removeprefix("file:") + "/_SUCCESS")
