"""Document fingerprints by consistent weighted sampling.

A text's terms are its lower-cased words, weighted by how often they occur; a
character of a script without spaces is a word of its own.  Each of SAMPLES
draws gives every (term, sample) two gamma variables and a uniform one from the
term's hash alone, rounds the term's weight down to a level of its own grid, and
keeps the term of least key.  Two texts keep the same (term, level) with the
probability of their generalised Jaccard similarity, the sum of the lesser
weights over the sum of the greater ones.  A fingerprint holds 16 bits of each
(term, level) kept; likeness is the share of equal ones.

``neighbours`` also compares each document with the next one in the order of ids
and with its own text after an edit that takes the next one's beginning.  The
texts move once, into ranges of ids; a task reads its range in order and holds
one text back until the next comes.  Only a range's first and last document are
compared again across the cuts, two rows a range.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays

SAMPLES = 64
#: Bytes of text fingerprinted at a time, or one text.
SLICE_BYTES = 4 << 20
_rng = np.random.default_rng(20250311)
SEEDS = _rng.integers(1, 2**63, (SAMPLES, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HALF = np.float32(2.0**-32)


def _uniforms(hashes: np.ndarray, seed: np.uint64, both: bool = True) -> tuple[np.ndarray, ...]:
    """Two numbers above 0 and below 1 for each hash, or the first of them."""
    h = hashes ^ seed
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    found = []
    for half in (h >> np.uint64(32), h & np.uint64(0xFFFFFFFF) if both else None):
        if half is not None:
            x = half.astype(np.float32)
            x += np.float32(0.5)
            x *= _HALF
            # at least 2**-33 as it is
            found.append(np.minimum(x, np.float32(1 - 2.0**-24), out=x))
    return tuple(found)


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the floats, in the upper 32 bits."""
    bits = x.view(np.uint32)
    bits = bits ^ ((bits.view(np.int32) >> 31).view(np.uint32) | np.uint32(0x80000000))
    return bits.astype(np.uint64) << np.uint64(32)


def samples(hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The samples (uint16) of texts whose terms, of positive weight, start at
    ``begin``, the last number the count of all; every text needs a term."""
    out = np.empty((len(begin) - 1, SAMPLES), np.uint16)
    if not len(out):
        return out
    terms, at = np.unique(hashes, return_inverse=True)
    at = at.astype(np.int32)
    # A term that occurs once is on level 0 in every sample.
    often = np.flatnonzero(weights != 1)
    log_weight, at_often = np.log(weights[often].astype(np.float32)), at[often]
    level = np.zeros(len(hashes), np.float32)
    number = np.arange(len(hashes), dtype=np.uint64)
    for k in range(SAMPLES):
        # Gamma(2, 1) is the sum of two exponential variables.
        r = -np.log(np.multiply(*_uniforms(terms, SEEDS[k, 0])))
        log_c = np.log(-np.log(np.multiply(*_uniforms(terms, SEEDS[k, 1]))))
        beta, = _uniforms(terms, SEEDS[k, 2], both=False)
        log_a = log_c - r + r * beta
        key = _ordered(log_a)[at]
        r_of = r[at_often]
        level[often] = np.floor(log_weight / r_of + beta[at_often])
        key[often] = _ordered(log_a[at_often] - r_of * level[often])
        key |= number
        least = np.minimum.reduceat(key, begin[:-1])
        pick = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        kept = hashes[pick] + level[pick].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out[:, k] = (textarrays.mix(kept) >> np.uint64(48)).astype(np.uint16)
    return out


def weighted_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and counts of each text's different words, and where each text's
    begin (one more than texts)."""
    data, offsets = textarrays.text_bytes(texts)
    starts, ends, first = textarrays.words(data, offsets, cut_scripts=True)
    h = textarrays.hash_runs(textarrays.LOWER[data], starts, ends)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.searchsorted(owner[at], np.arange(len(texts) + 1))


def fingerprints(texts: pa.Array) -> list[bytes]:
    """A text's samples as big-endian bytes; a text without words has none."""
    out = []
    sizes = np.diff(textarrays.text_bytes(texts)[1])
    for a, b in textarrays.slices(sizes, SLICE_BYTES):
        h, count, begin = weighted_terms(texts.slice(a, b - a))
        full = np.flatnonzero(np.diff(begin))
        found = samples(h, count, np.append(begin[full], begin[-1])).astype(">u2")
        part = [b""] * (b - a)
        for i, row in zip(full.tolist(), found, strict=True):
            part[i] = row.tobytes()
        out += part
    return out


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal samples; without words, a text is like such texts only."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (whole code points, rounded down) replaced
    by as many, or all, of the first of ``following``."""
    gone = len(text) // 4
    return text[:len(text) - gone] + following[:gone]


def fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col``, the fingerprint in lowercase hex.

    Null texts are empty; a text without words has an empty fingerprint; equal
    texts have equal ones.  A column of that name is replaced, others stay.
    """
    rest = docs.drop(out_col) if out_col != text_col else docs
    name = common.free_name(docs, "marks")
    schema = common.ddl(rest, f"`{name}` binary")

    def run(batches):
        for batch in batches:
            marks = pa.array(fingerprints(batch.column(batch.schema.get_field_index(text_col))), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, name])
        common.give_back()

    return rest.mapInArrow(run, schema).withColumn(out_col, F.lower(F.hex(name))).drop(name)


#: What a pair of neighbours gives, and the rows that wait at the cuts.
_FIELDS = [("edge", pa.int32()), ("h", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("sha", pa.binary()), ("mark", pa.binary()),
           ("edited_mark", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_DDL = "edge int, h long, text string, n_chars long, sha binary, mark binary, edited_mark binary, near_edited double, near_next double"


def _results(ids: pa.Array, texts: list[str], following: list[str]):
    """Record batch of finished rows: each text with the one that follows it."""
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    # The next text is the next row's own but for the last one.  A text and its
    # edited one stand side by side: they share most terms, drawn for once.
    pairs = [t for pair in zip(texts, changed, strict=True) for t in pair]
    marks = fingerprints(pa.array([*pairs, following[-1]], pa.large_string()))
    own, new = marks[0::2], marks[1::2]
    n = len(texts)
    columns = {"n_chars": pa.array(map(len, texts), pa.int64()), "sha": pa.array([hashlib.sha256(t.encode()).digest() for t in changed], pa.binary()),
               "mark": pa.array(own[:n], pa.binary()), "edited_mark": pa.array(new, pa.binary()),
               "near_edited": pa.array([likeness(a, b) for a, b in zip(own, new, strict=False)]),
               "near_next": pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)])}
    columns["edge"] = pa.array(np.zeros(n, np.int32))
    return pa.RecordBatch.from_arrays([ids, *(columns.get(f, pa.nulls(n, t)) for f, t in _FIELDS)], names=["id", *(f for f, _ in _FIELDS)])


def _edge(row: pa.RecordBatch, kind: int) -> pa.RecordBatch:
    values = {"edge": pa.array([kind], pa.int32()), "h": row.column("h"), "text": row.column("text")}
    return pa.RecordBatch.from_arrays([row.column("id"), *(values.get(f, pa.nulls(1, t)) for f, t in _FIELDS)], names=["id", *(f for f, _ in _FIELDS)])


def _within(batches):
    """Results of all rows of one range but the last, and its first and last row."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        if last is None:
            yield _edge(batch.slice(0, 1), 1)
        table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
        sizes = np.diff(textarrays.text_bytes(table["text"].combine_chunks())[1])
        for a, b in textarrays.slices(sizes[:-1], SLICE_BYTES):
            texts = table["text"].slice(a, b - a + 1).to_pylist()
            yield _results(table["id"].slice(a, b - a).combine_chunks(), texts[:-1], texts[1:])
        last = table.slice(len(table) - 1).to_batches()[0]
    if last is not None:
        yield _edge(last, 2)
    common.give_back()


def _across(batches):
    """Results of the ranges' last rows, of all first and last rows in order."""
    first = wait = None
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            first = first or row
            if wait is not None:
                yield _results(wait.column("id"), wait.column("text").to_pylist(), row.column("text").to_pylist())
            wait = row if row.column("edge")[0].as_py() == 2 else None
    if wait is not None:
        yield _results(wait.column("id"), wait.column("text").to_pylist(), first.column("text").to_pylist())


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint beside those of its edited text and of the next row.

    Returns ``(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``, a row per row of ``docs``.  The next row is that
    of the next id, rows without an id before all others, rows that repeat an id
    in the order of their texts' hash; after the last comes the first, so a lone
    row follows itself.  Null texts are empty; other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = common.shuffle_parts(spark)
    schema = f"id {src.schema['id'].dataType.simpleString()}, {_DDL}"
    ranged = src.repartitionByRange(parts, "id", "h").sortWithinPartitions("id", "h")
    found = common.written(ranged.mapInArrow(_within, schema), "fingerprints")
    # Two rows a range, read in order by one task that holds two of them.
    edges = found.where("edge > 0").select("id", "h", "edge", "text").repartition(1).sortWithinPartitions("id", "h", "edge")
    out = found.where("edge = 0").unionByName(edges.mapInArrow(_across, schema))
    return out.select(F.col("id").alias(id_col), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), F.lower(F.hex("mark")).alias("fingerprint"),
                      F.lower(F.hex("edited_mark")).alias("edited_fingerprint"), "near_edited", "near_next")


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and its successor."""
    return neighbours(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


common.by_value(__name__)
