"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid

import pyspark.cloudpickle as cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir


def by_value(*modules: str) -> None:
    """Ship these modules' functions with the task, so that executors need no
    copy of this package."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which the driver and
    all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cuts
    the lineage and survives the loss of executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, with underscores before it until no column of ``df`` begins so."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


def ddl(df: DataFrame, *extra: str) -> str:
    """DDL of the columns of ``df``, then ``extra``."""
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + list(extra))


def shuffle_parts(spark: SparkSession) -> int:
    """Tasks for a shuffle whose count is given: the session's own, or two a core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2)


def held_out(doc_id: Column | str) -> Column:
    """The fold that no model learns from: crc32 of the id's text mod 5 is 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bitmap(df: DataFrame, hash_col: str, bits: int):
    """A bit for the first ``bits`` bits of every hash, as numpy bytes.  At most
    2^(bits - 3) small rows reach the driver, whatever the size of ``df``; the
    fuller it gets, the more it lets pass, but it never misses."""
    import numpy as np

    top = F.shiftrightunsigned(hash_col, 64 - bits)
    rows = (df.select(F.shiftright(top, 3).cast("int").alias("byte"), F.expr(f"shiftleft(1, cast(shiftrightunsigned(`{hash_col}`, {64 - bits}) & 7 AS int))").alias("bit"))
            .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[rows["byte"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint8)
    return out


def in_bitmap(found, hashes):
    """Whether each (unsigned 64-bit) hash's bit is set."""
    import numpy as np

    bit = (hashes >> np.uint64(64 - (len(found) * 8).bit_length() + 1)).astype(np.int64)
    return ((found[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)


def open_store(uri: str):
    """The Arrow file system and path of a Hadoop-style uri, inside a task."""
    import re

    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


#: Rows of an Arrow batch: texts are large rows, and a batch is held several
#: times on its way between the JVM and Python.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let this session send at most ARROW_ROWS rows at a time to Python; a
    smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def give_back() -> None:
    """Return freed memory to the system; for tasks, whose worker stays on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spread(df: DataFrame, tasks_per_core: int = 2) -> DataFrame:
    """Give a CPU-bound narrow stage enough tasks when ``df``, a plain scan of a
    table, has few splits.  For queries; operators take their input as it comes."""
    target = df.sparkSession.sparkContext.defaultParallelism * tasks_per_core
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


by_value(__name__)
