"""W2 — incremental extraction with Structured Streaming.

New page files (parquet ``(category, source_path, html)``) arriving in a
folder are shredded and extracted per micro-batch and added to the entity
table.  The checkpoint records which files were processed, so a stopped run
resumes where it left off (the reference's resume offset, K7).  A page already
extracted is skipped (J6) by its exact ``(category, source_path)``: one rule
within a micro-batch (of equal keys the first by file and row stays) and across
all of them, whatever their size.

Keys seen so far lie in a ``KeyStore``, so the query itself has no state.  A
micro-batch publishes its entities and its keys together (``PublishedTables``):
readers see both or none, and one that runs again after that adds nothing.  Small
sets are merged as they add up; ``PublishedTables(spark, out_path).vacuum()``
deletes the merged ones and old manifests, when no reader needs them any more.
``trigger(availableNow=True)`` processes everything present and stops, which
makes the incremental run comparable to one batch run.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators.extract import ENTITY_SCHEMA, NODE_FIELDS, extract_entities
from docweave.operators.shred import shred
from docweave.sources.published import PublishedTables
from docweave.streaming.keystore import PIECE_BITS, KeyStore, bit_at

PAGE_SCHEMA = "category string, source_path string, html string"
PAGE_KEY = ["category", "source_path"]
_ROW = ["from_file", "from_row"]
MOST_BITMAPS = 8192


def _process(out_path: str, checkpoint: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        # A checkpoint's own id: the batches of a new one count from 0 again.
        stream = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        tables = PublishedTables(batch.sparkSession, out_path)
        store = KeyStore(tables, PAGE_KEY)
        if tables.published(stream, batch_id):
            return
        first = batch.groupBy(*PAGE_KEY).agg(F.min(F.struct(*_ROW)).alias("at")).select(*PAGE_KEY, "at.*")
        # A micro-batch is read whole each time, so its keys and places are written first.
        arrived = tables.stage("arrived", first)
        sets, new, notes = store.stage(store.new(tables.read_staged(arrived)))
        places = tables.stage("places", _bitmaps(new))
        pages = _at(batch, new, tables.read_staged(places))
        sets.append(tables.stage("entities", extract_entities(shred(pages, keep=PAGE_KEY, fields=NODE_FIELDS))))
        store.commit(sets, notes, stream, batch_id)
        tables.compact("entities")
        store.compact()
        tables.discard(arrived)
        tables.discard(places)

    return run


def _bitmaps(rows: DataFrame) -> DataFrame:
    """The rows' places as a bit each, by file and block of 32,768 rows."""
    block, place = F.floor(F.col(_ROW[1]) / PIECE_BITS), F.pmod(F.col(_ROW[1]), F.lit(PIECE_BITS))
    return rows.select(_ROW[0], block.alias("block"), place.alias("place")).groupBy(_ROW[0], "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _at(batch: DataFrame, new: DataFrame, places: DataFrame) -> DataFrame:
    """The whole pages at the places of the new ones; a place is unique.  Pages
    stay where they are and meet bitmaps, a bit a page; where many small files
    make more than ``MOST_BITMAPS`` (4 KB each), they meet the places by a join."""
    if places.count() > MOST_BITMAPS:
        return batch.join(new.select(*_ROW), _ROW, "left_semi").drop(*_ROW)
    block = F.floor(F.col(_ROW[1]) / PIECE_BITS)
    met = batch.withColumn("block", block).join(F.broadcast(places), [_ROW[0], "block"])
    return met.filter(bit_at("bits", F.pmod(F.col(_ROW[1]), F.lit(PIECE_BITS)))).drop("block", "bits", *_ROW)


def stream_extract(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, files_per_trigger: int | None = None):
    """Start the incremental extraction; returns the ``StreamingQuery``.
    ``files_per_trigger`` bounds a micro-batch and does not change the result."""
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    pages = reader.parquet(source_dir).select(
        "*", F.col("_metadata.file_path").alias(_ROW[0]), F.col("_metadata.row_index").alias(_ROW[1]))
    return (
        pages.writeStream.foreachBatch(_process(out_path, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_incremental(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                    files_per_trigger: int | None = None) -> DataFrame:
    """Run to completion (``availableNow``) and return the accumulated output."""
    stream_extract(spark, source_dir, out_path, checkpoint, files_per_trigger).awaitTermination()
    return extracted(spark, out_path)


def extracted(spark: SparkSession, out_path: str) -> DataFrame:
    """The entities published so far."""
    tables = PublishedTables(spark, out_path)
    if "entities" in tables.manifest()["tables"]:
        return tables.read("entities")
    return spark.createDataFrame([], T.StructType([T.StructField("category", T.StringType())] + ENTITY_SCHEMA.fields))
