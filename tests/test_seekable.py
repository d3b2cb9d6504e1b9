"""K6/K7: lines by number, appended runs."""

import io
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docweave.sources import seekable
from docweave.sources.sinks import write_sorted_ndjson


def rows(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a b+c%").when(F.col("id") % 3 == 1, "x").alias("category"), F.floor(F.col("id") / 3).alias("line"),
        F.concat(F.lit("é\\n"), F.repeat(F.lit("z"), F.pmod(F.hash("id"), F.lit(90)))).alias("text"))


def found(df):
    return {(r.category, r.line): json.loads(r.value)["text"] for r in df.collect()}


def test_append_and_look_up(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="dw-seek-", dir="/tmp") + "/out"
    monkeypatch.setattr(seekable, "STRIDE", 7)
    whole = {(r.category, r.line): r.text for r in rows(spark, 900).collect()}
    assert seekable.append_lines(rows(spark, 0), path) == 0
    assert found(seekable.read_lines(rows(spark, 3), path)) == {}
    write_sorted_ndjson(rows(spark, 250), path, ["line"], ["category"])
    # short blocks: some hold no start of a line, some several
    assert seekable.index_lines(spark, path, stride=7, block_bytes=64) == 1
    assert seekable.index_lines(spark, path) == 1
    assert found(seekable.read_lines(rows(spark, 900), path)) == {k: v for k, v in whole.items() if k in {(r.category, r.line) for r in rows(spark, 250).collect()}}
    # a run that wrote more and was stopped before it indexed it
    write_sorted_ndjson(rows(spark, 300).exceptAll(rows(spark, 250)), path, ["line"], ["category"], mode="append")
    assert seekable.append_lines(rows(spark, 900), path) == 3
    assert seekable.append_lines(rows(spark, 900), path) == 3
    assert spark.read.text(path).count() == 900
    twice = rows(spark, 900).unionByName(rows(spark, 1200))
    assert found(seekable.read_lines(twice, path)) == whole
    assert found(seekable.read_lines(rows(spark, 900).filter("line = 299"), path)) == {k: v for k, v in whole.items() if k[1] == 299}


def test_only_the_blocks_needed_are_read(spark):
    path = tempfile.mkdtemp(prefix="dw-seek-", dir="/tmp") + "/out"
    spark.range(40_000).select(F.lit("c").alias("category"), F.col("id").alias("line"), F.repeat(F.lit("y"), 100).alias("text")).coalesce(1).write.partitionBy("category").json(path)
    seekable.index_lines(spark, path)
    offsets = spark.read.parquet(f"{path}/_lines/offsets/gen=0").orderBy("line").collect()
    file = next(os.path.join(d, f) for d, _, fs in os.walk(f"{path}/category=c") for f in fs if f.startswith("part-"))
    with open(file, "rb") as f:
        data = f.read()
    starts = [0] + [i + 1 for i, c in enumerate(data[:-1]) if c == 10]
    assert [(r.line, r.offset) for r in offsets] == [(n, starts[n]) for n in range(0, 40_000, seekable.STRIDE)]
    assert all(r.until == min(r.line + seekable.STRIDE, 40_000) for r in offsets)


def test_line_starts():
    for data in (b"", b"a", b"a\n", b"\n\n", b"ab\ncd\n\ne", b"x" * 50 + b"\ny\n"):
        want = [i for i in range(len(data)) if i == 0 or data[i - 1] == 10]
        for step in (1, 2, 3, 100):
            got = [int(o) for a in range(0, len(data), step) for s in seekable._starts(io.BytesIO(data), a, min(a + step, len(data))) for o in s]
            assert got == want, (data, step)


def test_compressed_files_are_refused(spark):
    path = tempfile.mkdtemp(prefix="dw-seek-", dir="/tmp") + "/out"
    rows(spark, 9).write.partitionBy("category").option("compression", "gzip").json(path)
    with pytest.raises(ValueError, match="compressed"):
        seekable.index_lines(spark, path)
