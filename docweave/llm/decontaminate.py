"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits in lower case; a character of a script
without spaces is a token of its own.  A fixed mask picks WEIGHT
of a few neighbouring tokens and ignores those between, so a hash of the picked
ones survives a substitution in an ignored place.  The masks together hit every
stretch of MIN_OVERLAP tokens, and every whole item of SHORTEST_ITEM tokens or
more, of which MIN_SHARE agree (a test tries them all).

Training texts are scanned once.  A bitmap of the benchmark's seed hashes, of
fixed size whatever the benchmark's, drops most seeds; stretches with the others
are kept with their tokens.  Kept seeds join the benchmark's seeds by hash, each
hit names an alignment of a stretch with an item, and an alignment counts if
some MIN_OVERLAP tokens of it (the whole item, if that is shorter) agree in
MIN_SHARE.  The bitmap has false hits, never misses, and the join and the check
settle them, so a large benchmark costs more but loses nothing.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays

#: Offsets of the tokens that a mask picks.
MASKS = [(0, 1, 2, 3, 4), (0, 3, 4, 5, 6), (0, 2, 4, 5, 7), (0, 1, 2, 4, 6)]
MIN_OVERLAP = 13
MIN_SHARE = 0.8
#: Items with fewer tokens count only as whole, exact token sequences, if at all (``short``).
SHORTEST_ITEM = 8
WHOLE = [tuple(range(n)) for n in range(1, SHORTEST_ITEM)]
BITMAP_BITS = 24
#: Hits further apart than this belong to different stretches.
REACH = MIN_OVERLAP
SLICE_BYTES = 4 << 20

#: Bytes that part tokens: ASCII other than letters and digits.
PART = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the number of the first one of each text."""
    data, offsets = textarrays.text_bytes(pc.utf8_lower(texts))
    spaced = np.where(PART[data], np.uint8(32), data)
    starts, ends, first = textarrays.words(spaced, offsets, cut_scripts=True)
    return textarrays.hash_runs(data, starts, ends), first


def seed_hashes(hashes: np.ndarray, mask: int) -> np.ndarray:
    """The mask's hash at every position from which it fits."""
    picks = (MASKS + WHOLE)[mask]
    n = max(0, len(hashes) - picks[-1])
    h = np.full(n, mask + 1, np.uint64)
    for k in picks:
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    return textarrays.mix(h)


def _needed(length: int) -> int:
    return math.ceil(MIN_SHARE * length - 1e-9)


def benchmark_seeds(bench: DataFrame, id_col: str, text_col: str, short: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(item, item_tokens)`` and ``(hash, item, at)``, written."""
    fewest = 1 if short else SHORTEST_ITEM

    def run(batches):
        for batch in batches:
            hashes, first = tokens(batch.column(1))
            rows = [hashes[a:b].view(np.int64) if b - a >= fewest else None for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["item", "item_tokens"])

    items = bench.select(id_col, text_col).mapInArrow(run, "item long, item_tokens array<long>").where("item_tokens IS NOT NULL")
    # Items of the same tokens are one item, under the smallest id; an item without an id is -1.
    items = items.groupBy("item_tokens").agg(F.coalesce(F.min("item"), F.lit(-1)).alias("item"))
    items = common.written(items.select("item", F.xxhash64("item_tokens", "item").alias("item_key"), "item_tokens"), "bench-items")

    def seeds(batches):
        for batch in batches:
            for key, row in zip(batch.column(0), batch.column(1), strict=True):
                hashes = row.values.to_numpy().view(np.uint64)
                for mask in range(len(MASKS)) if len(hashes) >= SHORTEST_ITEM else [len(MASKS) + len(hashes) - 1]:
                    h = seed_hashes(hashes, mask)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), key.as_py()), pa.int64()),
                                                      pa.array(np.arange(len(h), dtype=np.int32))], names=["hash", "item_key", "at"])

    found = items.select("item_key", "item_tokens").mapInArrow(seeds, "hash long, item_key long, at int")
    return items, common.written(found, "bench-seeds")


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    return common.bitmap(seeds, "hash", BITMAP_BITS)


def _stretches(hashes: np.ndarray, first: np.ndarray, bitmap: np.ndarray, masks: list[int]):
    """``(row, token from, token to, seeds)`` of stretches around seeds whose bit
    is set; positions count from the batch's first token."""
    at, seed = [], []
    owner_end = np.repeat(first[1:], np.diff(first))
    for mask in masks:
        picks = (MASKS + WHOLE)[mask]
        h = seed_hashes(hashes, mask)
        hit = np.flatnonzero(common.in_bitmap(bitmap, h))
        hit = hit[hit + picks[-1] < owner_end[hit]]
        at.append(hit)
        seed.append(h[hit])
    at, seed = np.concatenate(at), np.concatenate(seed)
    order = np.argsort(at, kind="stable")
    at, seed = at[order], seed[order]
    if not len(at):
        return
    row = np.searchsorted(first, at, side="right") - 1
    cut = np.flatnonzero((np.diff(at) > REACH) | (np.diff(row) > 0)) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(at)), strict=True):
        r = row[a]
        yield r, max(first[r], at[a] - REACH), min(first[r + 1], at[b - 1] + MASKS[-1][-1] + MASKS[2][-1] + REACH), (seed[a:b], at[a:b])


def scan(docs: DataFrame, text_col: str, bitmap: np.ndarray, keep: list[str], lengths: list[int] = ()) -> DataFrame:
    """The ``keep`` columns of ``docs``, numbered ``c0``, ``c1``, … so that no name
    clashes, with ``row`` (a name for rows that have stretches, else null) and
    ``stretches``; ``lengths`` are those of the short items."""
    masks = [*range(len(MASKS)), *(len(MASKS) + n - 1 for n in lengths)]
    names = [*(f"c{i}" for i in range(len(keep))), "row", "stretches"]
    at, kept = docs.columns.index(text_col), [docs.columns.index(c) for c in keep]
    stretch = pa.struct([("tokens", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int32()))])
    schema = ", ".join([f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
                       + ["row string", "stretches array<struct<tokens:array<long>,hashes:array<long>,offsets:array<int>>>"])

    def run(batches):
        for batch in batches:
            sizes = np.diff(textarrays.text_bytes(batch.column(at))[1])
            for a, b in textarrays.slices(sizes, SLICE_BYTES):
                part = batch.slice(a, b - a)
                hashes, first = tokens(part.column(at))
                stamp, found = uuid.uuid4().hex, {}
                for r, x, y, (seed, where) in _stretches(hashes, first, bitmap, masks):
                    found.setdefault(int(r), []).append({"tokens": hashes[x:y].view(np.int64), "hashes": seed.view(np.int64), "offsets": (where - x).astype(np.int32)})
                rows = pa.array([f"{stamp}-{i}" if i in found else None for i in range(len(part))], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), rows, pa.array([found.get(i) for i in range(len(part))], pa.list_(stretch))], names=names)
        common.give_back()

    return docs.mapInArrow(run, schema)


def leaks(scanned: DataFrame, items: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(row, bench_items)`` of the rows that hold benchmark passages."""
    stretches = scanned.where("row IS NOT NULL").select("row", F.posexplode("stretches").alias("n", "s"))
    kept = stretches.select("row", "n", F.expr("explode(zip_with(s.hashes, s.offsets, (h, o) -> named_struct('hash', h, 'offset', o)))").alias("x")).select(
        "row", "n", F.col("x.hash").alias("hash"), F.col("x.offset").alias("offset"))
    hits = kept.join(seeds, "hash").select("row", "n", "item_key", (F.col("offset") - F.col("at")).alias("shift")).distinct()
    aligned = (hits.join(stretches.select("row", "n", F.col("s.tokens").alias("tokens")), ["row", "n"])
               .join(items, "item_key")
               .withColumn("agree", F.expr("transform(item_tokens, (t, i) -> IF(i + shift >= 0 AND i + shift < size(tokens) AND get(tokens, i + shift) = t, 1, 0))"))
               .withColumn("need", F.expr(f"least(size(item_tokens), {MIN_OVERLAP})")))
    least = "CASE need " + " ".join(f"WHEN {n} THEN {n if n < SHORTEST_ITEM else _needed(n)}" for n in range(1, MIN_OVERLAP + 1)) + " END"
    good = f"exists(sequence(1, size(agree) - need + 1), i -> aggregate(slice(agree, i, need), 0, (a, x) -> a + x) >= {least})"
    return aligned.where(good).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("bench_items"))


def find_leaks(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               keep: list[str] | None = None, out: tuple[str, str] = ("contaminated", "bench_items"), short: bool = False) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with ``contaminated`` and
    ``bench_items``, the ids of the items whose passages the text holds, under
    the names ``out`` (columns of these names are replaced, others stay).

    Null and empty texts and items hold nothing; items with fewer than
    SHORTEST_ITEM tokens are left out unless ``short``, when their whole token
    sequence must occur exactly; items of equal tokens count as the one of
    the smallest id; rows that repeat are judged each, with or without an id.
    """
    docs = docs.drop(*out)
    keep = docs.columns if keep is None else keep
    items, seeds = benchmark_seeds(bench, item_col, item_text_col, short)
    sizes = items.select(F.size("item_tokens").alias("n")).where(f"n < {SHORTEST_ITEM}").distinct()
    lengths = sorted(x["n"] for x in sizes.collect())
    scanned = common.written(scan(docs, text_col, seed_bitmap(seeds), keep, lengths), "bench-scan")
    none = F.expr("cast(array() AS array<bigint>)")
    # Most rows have no stretch and need no join.
    clean = scanned.where("row IS NULL").drop("row", "stretches").withColumn("bench_items", none)
    rest = scanned.where("row IS NOT NULL").drop("stretches").join(leaks(scanned, items, seeds), "row", "left").drop("row")
    both = clean.unionByName(rest.withColumn("bench_items", F.coalesce("bench_items", none)))
    return both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], (F.size("bench_items") > 0).alias(out[0]), F.col("bench_items").alias(out[1]))


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document holds a benchmark passage, and of which items."""
    docs = common.spread(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return find_leaks(docs, common.table(spark, sf_dir, "benchmark"), keep=["doc_id"], short=True).select(
        "doc_id", "contaminated", F.concat_ws(",", F.expr("transform(bench_items, x -> cast(x AS string))")).alias("items"))


common.by_value(__name__)
