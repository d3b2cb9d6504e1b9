"""Rendered pages: members in chunks, dealt as narrow rows, never written as node tables."""

import datetime
import os
import re

from pyspark.sql import functions as F

from docweave.plans import catalog
from docweave.plans import fixtures as X
from docweave.session import ensure_checkpoint_dir


def test_members_of_large_null_and_repeated_keys(spark):
    rows = [("hot", i, f"h{i}") for i in range(10)] + [("a", 1, "a1"), ("a", None, "a?"), ("a", 2, "a2"), (None, 5, "none")]
    members = spark.createDataFrame(rows, "k string, r long, v string")
    entities = spark.createDataFrame([("hot", "H"), ("hot", "H2"), ("a", "A"), ("b", "B"), (None, "N")], "k string, name string")
    pages = X.Pages(members, "k", F.col("r"), F.col("v"), [F.col("r")], rows_per_page=3)
    got = sorted((r.name, r.chunk, r.body) for r in pages.of(entities).collect())
    hot = [(c, "".join(f"h{i}" for i in range(10) if i % 4 == c)) for c in range(4)]
    want = [(n, c, b) for n in ("H", "H2") for c, b in hot] + [("A", 0, "a?"), ("A", 0, "a1a2"), ("B", 0, ""), ("N", 0, "")]
    assert got == sorted(want)
    assert sorted((r.k, r.chunk is None, r.body) for r in pages.bodies().collect()) == sorted(
        [("hot", False, b) for _, b in hot] + [("a", True, "a?"), ("a", False, "a1a2")])


def _tables(spark, d):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")

    put("part", [(i, f"part {i}", "Brand#1", "TIN", i) for i in range(1, 5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    put("nation", [(i, f"N{i}", 0) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    put("lineitem", [(o, 1 + o % 3, 1, "A", datetime.date(1998, 1, 2)) for o in range(30)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_shipdate date")


def test_pages_are_neither_written_nor_shuffled(spark, tmp_path):
    d = str(tmp_path)
    _tables(spark, d)
    ckpt = re.sub("^file:/+", "/", ensure_checkpoint_dir(spark))
    before = sorted(os.listdir(ckpt))
    q = catalog.q_class_variables(spark, d)
    assert q.count() == 30
    assert sorted(os.listdir(ckpt)) == before
    plan = X.x1_class_pages(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Repartition 1" not in plan
    dealt = [line for line in plan.splitlines() if "RepartitionByExpression" in line]
    assert dealt and not any("frag" in line or "body" in line or "html" in line for line in dealt)
