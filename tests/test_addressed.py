import datetime as dt

from pyspark.sql import functions as F

from docweave.operators import curate as C
from docweave.sources import addressed as A


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_type_comes_back(spark):
    day = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [(i, "é" * (i % 5) if i % 7 else None, [i, None], {"k": i}, (i, ["a"]), day + dt.timedelta(days=i), bytes([i % 256])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s string, a array<int>, m map<string,int>, t struct<x:int,l:array<string>>, at timestamp, b binary")
    df = df.withColumns({"ntz": F.col("at").cast("timestamp_ntz"), "d": F.col("at").cast("date"), "n": F.col("id").cast("decimal(20,3)")}).repartition(3)
    kept = A.with_addresses(df).filter("id % 3 = 0").select(A.FILE, A.ROW)
    out = A.fetch(kept, df)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, out.collect())) == sorted(map(str, df.filter("id % 3 = 0").collect()))
    assert A.fetch(kept.filter("false"), df).count() == 0


def test_only_the_asked_columns_are_read_for_the_choice(spark):
    df = spark.range(10).withColumn("text", F.lit("t"))
    plan = A.with_addresses(df).select("id", A.ROW)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint," in plan and "text" not in plan, plan


def test_dedupe_by_address_equals_dedupe(spark):
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("source_path"),
        F.element_at(F.array(*map(F.lit, C.CATEGORY_ORDER)), (F.col("id") * 7 % 4 + 1).cast("int")).alias("category"),
        (F.col("id") * 31 % 6007).alias("line"), F.repeat(F.col("id").cast("string"), 20).alias("text")).repartition(7)
    assert _rows(C.dedupe(df, by_address=True)) == _rows(C.dedupe(df))
    assert _rows(C.dedupe(df, order=[F.col("line")], by_address=True)) == _rows(C.dedupe(df, order=[F.col("line")]))
    assert _rows(C.last_wins(df, "source_path", "line", by_address=True)) == _rows(C.last_wins(df, "source_path", "line"))


def test_ties_nulls_and_empty_tables(spark):
    schema = "source_path string, line long, v string"
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", None, "n"), ("b", None, "y"), ("", 1, "e"), (None, 2, "z")], schema)
    assert _rows(C.dedupe(df, by_address=True)) == [("a", 1, "x"), ("b", None, "y")]
    assert _rows(C.last_wins(df, "source_path", "line", by_address=True)) == sorted(
        [("a", 1, "x"), ("b", None, "y"), ("", 1, "e"), (None, 2, "z")], key=repr)
    assert C.dedupe(spark.createDataFrame([], schema), by_address=True).count() == 0
    many = spark.createDataFrame([("a", "p", i) for i in range(5)], "k string, l string, i int")
    assert C.dedupe(many, key=["k", "l"], by_address=True).count() == 1


def test_no_whole_row_is_exchanged_and_picked_rows_are_dealt_evenly(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("source_path"),
                                      F.col("id").alias("line"), F.lit("text").alias("wide")).coalesce(1)
    out = C.dedupe(df, by_address=True)
    below = out._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1].split("\n", 1)[1]
    assert "wide" not in below and "partial_min" in below, below
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 13334 and (len(sizes) == 1 or max(sizes) < 2 * sum(sizes) / len(sizes))
