"""K1–K7 — NDJSON sinks, line positions and resume.

``write_ndjson`` writes one JSON object per line with nulls kept (F8),
partitioned by category when asked; Spark's commit protocol makes a write
all-or-nothing (D16).

Line numbers (K6) are dense ordinals inside each category.  A window
``row_number() OVER (PARTITION BY category ORDER BY …)`` would put a whole
category in one task, so instead: range-sort the rows (distributed), persist
the sorted frame with ``checkpoint()`` in the shared checkpoint folder (so
partition ids are stable and a lost executor does not re-sort), count rows per
(sorted partition, category) — a table as small as the number of partitions —
turn those counts into start offsets, and add each row's index inside its
partition.  Every step is partition-parallel; Spark broadcasts the offset table
only if it measures it as small.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir
from docweave.sources import page_packs

# The tree writer's code is shipped with the task (pickled by value).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LOCAL_MASK = (1 << 33) - 1


def write_ndjson(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                 compression: str = "none") -> None:
    """K1–K5: NDJSON with nulls kept and raw UTF-8; plain, or compressed by a codec's name."""
    w = df.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_page_tree(pages: DataFrame, root: str, packed: bool = False) -> int:
    """Write ``(category, source_path, html)`` rows as files
    ``<root>/<category>/<source_path>``, by the tasks that hold them (``root`` on
    a file system that all share); the number of files.  A task that runs again
    writes the same files.  ``packed`` writes the pages of each category into
    packs (``page_packs.py``), which read as the files would."""
    if packed:
        return page_packs.write(pages, root, open_store)

    def run(batches):
        for batch in batches:
            store, base = open_store(root)
            for category, path, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = f"{base}/{category}/{path}"
                store.create_dir(at.rpartition("/")[0], recursive=True)
                with store.open_output_stream(at, compression=None) as f:
                    f.write((html or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    rows = pages.select("category", "source_path", "html").mapInArrow(run, "n long")
    return rows.agg(F.sum("n")).first()[0] or 0


def open_store(uri: str):
    """The Arrow file system and path of a Hadoop-style uri, inside a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^(file:)?/+", "file:///", uri)))


def write_sorted_ndjson(df: DataFrame, path: str, order: list[str], partition_by: list[str], mode: str = "overwrite") -> None:
    """NDJSON whose lines follow ``order`` inside each partition, over as
    many files as the range sort has tasks (their names sort in that order)."""
    by = [*partition_by, *order]
    write_ndjson(df.repartitionByRange(*by).sortWithinPartitions(*by), path, partition_by, mode)


def written_positions(spark, path: str, group: str = "category", key: str = "source_path") -> DataFrame:
    """K6: where each record was written, ``(group, key, file, line)`` with the
    0-based line in its file, read back from the files themselves; of a key
    written more than once the last place."""
    lines = spark.read.text(path).select(
        group, F.get_json_object("value", f"$.{key}").alias(key), F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0).alias("file"),
        F.concat_ws("/", group, F.col("_metadata.file_name")).alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_at"))
    numbered = line_numbers(lines, "_file", ["_at"])
    return numbered.groupBy(group, key).agg(F.max(F.struct("file", "line")).alias("p")).select(group, key, "p.file", "p.line")


def line_numbers(df: DataFrame, group: str, order: list[Column | str], out: str = "line") -> DataFrame:
    """Dense 0-based ordinal of each row inside its ``group``, by ``order``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    sorted_df = (
        df.orderBy(F.col(group), *order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    )
    sorted_df = sorted_df.checkpoint(eager=True)
    counts = sorted_df.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", group, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    # first row index (inside the partition) of each group in each partition
    firsts = sorted_df.groupBy("_pid", group).agg(F.min(F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))).alias("_first"))
    offsets = offsets.join(firsts, ["_pid", group])
    joined = sorted_df.join(offsets, ["_pid", group])
    local = F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)) - F.col("_first")
    return joined.withColumn(out, (F.col("_start") + local).cast("long")).drop("_mid", "_pid", "_start", "_first")


def position_index(df: DataFrame, group: str = "category", order: list[Column | str] | None = None,
                   key: str = "source_path") -> DataFrame:
    """K6: ``(category, source_path, line)``; a duplicated path keeps its last line."""
    numbered = line_numbers(df.select(group, key, *(order or [])), group, order or [key])
    return numbered.groupBy(group, key).agg(F.max("line").alias("line"))


def resume(positions: DataFrame, start: int) -> DataFrame:
    """K7: the rows from line ``start`` onwards (append them with ``mode='append'``)."""
    return positions.filter(F.col("line") >= start)
