"""K6, K7 — lines of written files found by their number, and runs that go on
where the files end.

Beside the NDJSON files of a sink lies an index, in a folder ``_lines`` that
readers of the sink do not see: the byte offset of every ``STRIDE``-th line of a
group and of each file's first.  A line's number names its index row, so a lookup
is a join by equal keys; a task opens the file there and reads up to the lines
asked for, no further.

Files are indexed once: each call adds a generation for the files that are new,
cut into blocks so that a large file is counted by many tasks.  Within a group
(a ``group=value`` folder) the lines follow the generations, and in one the file
names.  Files are plain UTF-8; compressed ones can't be entered midway and are an
error.
"""

from __future__ import annotations

import io
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.session import materialize, path_exists
from docweave.sources.sinks import open_store, write_sorted_ndjson

# The readers' code is shipped with the task (pickled by value).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[open_store.__module__])

STRIDE = 1024
BLOCK_BYTES = 32 << 20
_CHUNK = 1 << 20
_OFFSETS = "grp string, bucket long, line long, until long, file string, offset long"
_FILES = "grp string, file string, first long, lines long, stride long"


def _starts(file, start: int, end: int):
    """Arrays of the offsets in ``[start, end)`` at which lines start; ``end`` is
    at most the file's size, so a last line break starts none."""
    if start == 0 and end > 0:
        yield np.zeros(1, np.int64)
    at = max(start - 1, 0)
    file.seek(at)
    while at < end - 1:
        data = file.read(min(_CHUNK, end - 1 - at))
        if not data:
            return
        yield np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + at + 1
        at += len(data)


def _over_blocks(blocks: DataFrame, root: str, schema: str, rows_of) -> DataFrame:
    """``rows_of(open file, block row)`` of every block, as Arrow batches."""

    def run(batches):
        store, base = open_store(root)
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{base}/{r['file']}") as f:
                    yield from rows_of(f, r)

    return blocks.mapInArrow(run, schema)


def _count(file, r):
    n = sum(len(s) for s in _starts(file, r["start"], r["end"]))
    yield pa.RecordBatch.from_pylist([{**r, "lines": n}])


def _strided(stride: int):
    """The offsets of a block's lines whose number in the group divides by the
    stride, and of a file's first line."""

    def rows(file, r):
        line = r["line"]
        for starts in _starts(file, r["start"], r["end"]):
            numbers = np.arange(line, line + len(starts))
            line += len(starts)
            hit = (numbers % stride == 0) | (numbers == r["first"])
            if hit.any():
                n, bucket = int(hit.sum()), numbers[hit] // stride
                until = np.minimum((bucket + 1) * stride, r["first"] + r["total"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["grp"]] * n, pa.string()), pa.array(bucket), pa.array(numbers[hit]), pa.array(until), pa.array([r["file"]] * n), pa.array(starts[hit])],
                    names=["grp", "bucket", "line", "until", "file", "offset"])

    return rows


def _root(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def _generations(spark: SparkSession, root: str) -> int:
    n = 0
    while path_exists(spark, f"{root}/_lines/files/gen={n}/_SUCCESS"):
        n += 1
    return n


def _read(spark: SparkSession, root: str, what: str, schema: str, gens: int) -> DataFrame:
    if not gens:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/_lines/{what}/gen={g}" for g in range(gens)])


def _files(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "files", _FILES, _generations(spark, root))


def index_lines(spark: SparkSession, path: str, group: str = "category", stride: int = STRIDE, block_bytes: int = BLOCK_BYTES) -> int:
    """Index the files under ``path`` that no generation has yet; how many
    generations there are.  A run that is stopped leaves no generation.  A sink
    keeps the stride that it was first indexed with."""
    root = _root(spark, path)
    gens, deal = _generations(spark, root), spark.sparkContext.defaultParallelism * 4
    known = _files(spark, root)
    stride = known.first().stride if gens else stride
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        F.expr(f"substring(path, {len(root) + 2})").alias("file"), "length").filter("length > 0")
    new = materialize(listed.join(known.select("file"), "file", "left_anti"))
    packed = new.filter(F.col("file").rlike(r"\.(gz|bz2|zst|xz|lz4|snappy|deflate)$")).first()
    if packed:
        raise ValueError(f"{packed.file} is compressed: its lines have no offsets")
    if new.isEmpty():
        return gens
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long")))
    blocks = new.select("file", "length", starts.alias("start")).select(
        "file", "start", F.least(F.col("start") + block_bytes, F.col("length")).alias("end"))
    counted = materialize(_over_blocks(blocks.repartition(deal, "file", "start"), root, "file string, start long, end long, lines long", _count))
    # Windows over a row per file and a row per block: a terabyte in one file has some 32,000.
    folder = F.regexp_extract("file", f"(?:^|/){group}=([^/]*)/", 1)
    name = F.when(folder != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
    totals = counted.groupBy("file").agg(F.sum("lines").alias("total")).withColumn("grp", name)
    before = known.groupBy("grp").agg(F.sum("lines").alias("n")).withColumnRenamed("grp", "g")

    def sum_before(col: str, by: str, order: str):
        w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(col).over(w), F.lit(0))

    files = materialize(totals.join(before, F.col("grp").eqNullSafe(F.col("g")), "left").select(
        "grp", "file", (F.coalesce("n", F.lit(0)) + sum_before("total", "grp", "file")).alias("first"), "total"))
    placed = counted.withColumn("inside", sum_before("lines", "file", "start")).filter("lines > 0").join(files, "file").withColumn(
        "line", F.col("first") + F.col("inside"))
    found = _over_blocks(placed.select("grp", "file", "first", "total", "line", "start", "end").repartition(deal, "file", "start"), root, _OFFSETS, _strided(stride))
    found.write.mode("overwrite").parquet(f"{root}/_lines/offsets/gen={gens}")
    # Written last: a generation counts when its list of files is there.
    files.select("grp", "file", "first", F.col("total").alias("lines"), F.lit(stride).cast("long").alias("stride")).write.mode("overwrite").parquet(
        f"{root}/_lines/files/gen={gens}")
    return gens + 1


def read_lines(wanted: DataFrame, path: str, group: str = "category", line: str = "line") -> DataFrame:
    """K6: the lines ``wanted (group, line)`` asks for, as ``(group, line, value)``;
    numbers that the sink does not have give no row, equal ones one."""
    spark = wanted.sparkSession
    root = _root(spark, path)
    gens = _generations(spark, root)
    if not gens:
        return spark.createDataFrame([], f"`{group}` string, `{line}` long, value string")
    stride = _files(spark, root).first().stride
    asked = wanted.select(F.col(group).cast("string").alias("g"), F.col(line).cast("long").alias("l")).distinct().withColumn(
        "b", F.floor(F.col("l") / F.lit(stride)).cast("long"))
    # A group's bucket holds at most ``stride`` lines, so as many pieces and lists as long.
    hit = asked.join(_read(spark, root, "offsets", _OFFSETS, gens),
                     F.col("g").eqNullSafe(F.col("grp")) & (F.col("b") == F.col("bucket")) & (F.col("l") >= F.col("line")) & (F.col("l") < F.col("until")))
    pieces = hit.groupBy("grp", "file", "line", "offset").agg(F.array_sort(F.collect_list("l")).alias("lines"))

    def rows(file, r):
        file.seek(r["offset"])
        reader, at, out = io.BufferedReader(file, 1 << 16), r["line"], []
        for want in r["lines"]:
            while at < want:
                reader.readline()
                at += 1
            out.append(reader.readline().rstrip(b"\n").decode())
            at += 1
        reader.detach()
        yield pa.RecordBatch.from_arrays([pa.array([r["grp"]] * len(out), pa.string()), pa.array(r["lines"], pa.int64()), pa.array(out, pa.string())],
                                         names=[group, line, "value"])

    return _over_blocks(pieces, root, f"`{group}` string, `{line}` long, value string", rows)


def append_lines(df: DataFrame, path: str, group: str = "category", line: str = "line") -> int:
    """K7: write the rows of ``df`` from each group's first missing line onwards, and
    index them; the generations.  Rows are numbered from 0 within their group by
    ``line``; those already in the sink are not written again, whether or not the
    run that wrote them came to index them."""
    spark = df.sparkSession
    root = _root(spark, path)
    if path_exists(spark, root):
        index_lines(spark, root, group)
    # a row per group
    have = _files(spark, root).groupBy("grp").agg(F.sum("lines").alias("have"))
    rest = df.join(have, F.col(group).eqNullSafe(F.col("grp")), "left").filter(F.col(line) >= F.coalesce("have", F.lit(0))).drop("grp", "have")
    rest = materialize(rest)
    if not rest.isEmpty():
        write_sorted_ndjson(rest, root, [line], [group], mode="append")
    return index_lines(spark, root, group) if path_exists(spark, root) else 0
