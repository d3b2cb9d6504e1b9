from pyspark.sql import functions as F

from docweave.operators import curate as C


def test_dedupe_first_by_category_then_line_and_idempotent(spark):
    rows = [("runtime", "a", 0, "r0"), ("developer", "a", 5, "d5"), ("developer", "a", 2, "d2"),
            ("editor", "b", 9, "e9"), ("plugins", "b", 1, "p1"), ("editor", "", 0, "empty"), ("editor", None, 0, "null")]
    df = spark.createDataFrame(rows, "category string, source_path string, line long, v string")
    out = C.dedupe(df)
    got = sorted((r.source_path, r.v) for r in out.collect())
    assert got == [("a", "d2"), ("b", "e9")]
    assert sorted((r.source_path, r.v) for r in C.dedupe(out).collect()) == got


def test_dedupe_sorts_and_gathers_no_whole_rows(spark):
    """The key's winner is found on narrow rows, pre-aggregated; whole rows meet
    the winners in a hash join."""
    df = spark.range(0, 5000).select(F.lit("hot").alias("source_path"), F.col("id").alias("line"), F.lit("text").alias("text"))
    for out in (C.dedupe(df, unique_order=True), C.last_wins(df, "source_path", "line", unique_order=True)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort" not in plan and "partial_m" in plan, plan
        assert out.count() == 1
    assert C.dedupe(df).collect()[0].line == 0


def test_dedupe_of_rows_that_tie(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y")], "source_path string, line long, v string")
    assert [tuple(r) for r in C.dedupe(df).collect()] == [("a", 1, "x")]
    none = spark.createDataFrame([("a", None, "x")], "source_path string, line long, v string")
    assert C.dedupe(none).count() == 1 and C.last_wins(none, "source_path", "line").count() == 1
    two = spark.createDataFrame([("a", "b", 2), ("a", "b", 1), ("a,b", "", 5)], "k string, l string, line long")
    assert sorted(tuple(r) for r in C.dedupe(two, key=["k", "l"]).collect()) == [("a", "b", 1)]


def test_last_wins(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 3, "c"), ("x", 2, "b")], "name string, line long, v string")
    assert C.last_wins(df, "name", "line").collect()[0].v == "c"


def test_sanitize_missing_vs_null(spark):
    lines = spark.createDataFrame([
        ('{"name": "  a \\t b ", "navigation": "x", "module": null}',),
        ('{"name": "c", "navigation": [" p ", "q"], "entity_type": "enum"}',),
        ('{"name": null, "navigation": null}',),
        ('not json',),
    ], "value string")
    p = C.parse_entity_lines(lines)
    got = {r.name: r.asDict() for r in C.sanitize(p).collect()}
    assert got["a b"]["navigation"] == [] and got["a b"]["module"] is None and got["a b"]["header"] == ""
    assert got["a b"]["entity_type"] == "unknown"
    assert got["c"]["navigation"] == [" p ", "q"] and got["c"]["entity_type"] == "enum"
    assert got[None]["navigation"] == [] and got[None]["source_path"] == ""
    errs = C.sanitize_errors(p).collect()[0]
    assert errs.n_lines == 4 and errs.n_errors == 1


def test_sample_is_in_line_order_and_stripped(spark):
    from docweave.operators.quality import sample_records

    df = spark.createDataFrame([(1, " \t" + "a" * 600), (0, "b \n"), (2, "c")], "line long, text string")
    got = [(r.line_no, len(r.snippet)) for r in sample_records(df, "line", "text", k=10).collect()]
    assert got == [(1, 1), (2, 500), (3, 1)]
    many = spark.range(500).select(F.col("id").alias("line"), F.lit("x").alias("text"))
    lines = [r.line_no for r in sample_records(many, "line", "text", k=7).collect()]
    assert len(lines) == 7 and lines == sorted(lines)


def test_only_new_uses_exact_category_and_path(spark):
    from docweave.operators.quality import only_new

    pages = spark.createDataFrame([("d", "a/b"), ("r", "a/b"), ("d", "a__b"), ("d", "x")], "category string, source_path string")
    done = spark.createDataFrame([("d", "a/b")], "category string, source_path string")
    assert sorted(tuple(r) for r in only_new(pages, done).collect()) == [("d", "a__b"), ("d", "x"), ("r", "a/b")]


def test_counts_per_file_and_in_all(spark):
    from docweave.operators.quality import record_counts

    df = spark.createDataFrame([("a", "f1"), ("a", "f1"), ("a", "f2"), ("b", "f1")], "category string, file string")
    got = {(r.category, r.file): (r.n_records, r.n_files) for r in record_counts(df, "category", "file").collect()}
    assert got == {("a", "f1"): (2, 1), ("a", "f2"): (1, 1), ("a", None): (3, 2), ("b", "f1"): (1, 1), ("b", None): (1, 1), (None, None): (4, 3)}
