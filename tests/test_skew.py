from pyspark.sql import functions as F

from docweave.operators import hierarchy as H
from docweave.operators.skew import hot_keys, salted_join


def test_hot_key_is_dealt_over_tasks(spark):
    """Half of all rows hold one key: with the salt no task reads much more than the others."""
    rows = spark.range(8000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"))
    other = rows.select("k").distinct().withColumn("v", F.length("k"))
    assert [tuple(r) for r in hot_keys(rows, "k").collect()] == [("hot", 32)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for how in ("inner", "left_semi"):
            out = salted_join(rows, other, "k", ["id"], how)
            assert sorted(r.id for r in out.select("id").collect()) == list(range(8000))
            assert out.columns == (["k", "id", "v"] if how == "inner" else ["k", "id"])
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
            assert sizes[-1] < 3 * sizes[len(sizes) // 2]
            assert "_salt" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_salted_join_of_nulls_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3), ("c", 4)], "k string, id int")
    other = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), (None, "n")], "k string, v string")
    assert sorted(tuple(r) for r in salted_join(rows, other, "k", ["id"]).collect()) == [("a", 1, "x")] * 2 + [("a", 1, "y")] * 2 + [("b", 3, "z")]
    assert sorted(tuple(r) for r in salted_join(rows, other, "k", ["id"], "left_semi").collect()) == [("a", 1), ("a", 1), ("b", 3)]
    assert salted_join(rows.limit(0), other, "k", ["id"]).count() == salted_join(rows, other.limit(0), "k", ["id"]).count() == 0


def test_related_entities_of_a_hot_crumb(spark):
    others = spark.range(3000).select(F.col("id").cast("string").alias("source_path"), F.when(F.col("id") % 3 < 2, F.array(F.lit("Hot"), F.lit("no"))).otherwise(
        F.array(F.concat(F.lit("C"), F.col("id")))).alias("navigation"))
    names = others.select(F.element_at("navigation", 1).alias("name"))
    got = H.related_entities(others, names)
    assert {r.class_name: r.n_related for r in H.related_counts(got).filter("n_related > 1").collect()} == {"Hot": 2000}
    assert got.count() == 3000
