"""Token-id files: whole texts as ids, coded by the range coder in blocks.

A file holds the documents of one range of ids, in order:

* ``MAGIC``;
* blocks of BLOCK_IDS ids (the last has fewer), which run on across documents:
  u32 ids, u32 bytes, u32 crc32 of the ids as little-endian u32, coded bytes.
  Each block starts its model and its coder anew and decodes by its bytes alone;
* the documents' table, zlib-packed: a byte per document that tells whether it
  has an id, the ids as i64, their lengths as i64;
* u64 where the table begins, u32 its bytes, u32 its crc32, u32 documents,
  ``MAGIC``.

All numbers are little-endian.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm import common, range_coder, textarrays

MAGIC = b"DWTOKEN3"
BLOCK_IDS = 1024
#: Blocks coded side by side; bounds a task's memory.
LANES = 4096
#: Bytes of text tokenized at a time, and different words a worker remembers.
SLICE_BYTES = 4 << 20
LEARN_WORDS = 1000
CACHE_WORDS = 600_000
END_ID = 1


#: A split that makes words of letters of their own, the letters (of one byte, and
#: of two that begin with LEAD) and the marks that Words relies on with it.
LETTERS_APART = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
LETTERS, MARKS, LEAD = "[A-Za-zÀ-ÖØ-öø-ÿ]", ".,;:!?", 0xC3
_IS_LETTER = np.array([chr(i).isascii() and chr(i).isalpha() for i in range(256)])
_IS_SECOND = np.array([0x80 <= i < 0xC0 and i not in (0x97, 0xB7) for i in range(256)])
_IS_MARK = np.array([chr(i) in MARKS for i in range(256)])


def _cut_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut where a mark follows a letter, and the first word of each text."""
    marks = np.flatnonzero(_IS_MARK[data[1:]]) + 1
    before = data[marks - 1]
    cuts = marks[_IS_LETTER[before] | _IS_SECOND[before] & (data[marks - 2] == LEAD) & (marks > 1)]
    # A letter's word goes on with the mark unless the mark is the next text's.
    word = np.searchsorted(starts, cuts, side="right") - 1
    inside = starts[word] < cuts
    cuts, word = cuts[inside], word[inside]
    added = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(starts)))])
    return np.insert(starts, word + 1, cuts), np.insert(ends, word, cuts), first + added[first]


class Words:
    """The tokenizer's ids of words, remembered.  The tokenizer drops white space
    and never looks across it, so a text's ids are those of the runs between."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        splits = (config["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        contents = [t["content"] for t in config["added_tokens"]]
        #: The library makes one word of letters, whatever white space or mark is beside them.
        self.letters_apart = (splits[0].get("pattern") == {"Regex": LETTERS_APART} and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
                              and not any(re.search(f"{LETTERS}[{MARKS}]|^{LETTERS}+$", c) for c in contents))
        vocab, suffix = self.tokenizer.get_vocab(), config["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _library(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of words, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch(words.to_pylist(), add_special_tokens=False)]
        return np.array([x for i in ids for x in i], np.uint32), np.array([len(i) for i in ids], np.int64)

    def _library_at_once(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters, given to the library as one text, which
        costs less than a text a word: a word ends with the token that says so."""
        text = " ".join(words.to_pylist())
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(self.ends[ids])
        if len(at) != len(words) or at[-1] != len(ids) - 1:
            return self._library(words)
        return ids, np.diff(at, prepend=-1)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Remember new words; their numbers among the known."""
        letters = pc.match_substring_regex(words, f"^{LETTERS}+$") if self.letters_apart else pa.repeat(False, len(words))
        plain, other = words.filter(letters), words.filter(pc.invert(letters))
        found = [self._library_at_once(plain.slice(a, LEARN_WORDS)) for a in range(0, len(plain), LEARN_WORDS)]
        found += [self._library(other.slice(a, LEARN_WORDS)) for a in range(0, len(other), LEARN_WORDS)]
        ids, counts = zip(*found, strict=True)
        is_plain = letters.to_numpy(zero_copy_only=False)
        numbers = len(self.known) + np.where(is_plain, np.cumsum(is_plain) - 1, len(plain) + np.cumsum(~is_plain) - 1)
        self.known = pa.concat_arrays([self.known, plain, other])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])
        self.flat = np.concatenate([self.flat, *ids])
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has; null is empty."""
        data, offsets = textarrays.text_bytes(texts)
        starts, ends, first = textarrays.words(data, offsets)
        if self.letters_apart:
            starts, ends, first = _cut_marks(data, starts, ends, first)
        n = ends - starts
        solid = data[~textarrays.SPACE[data]]
        words = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(n)])), pa.py_buffer(np.ascontiguousarray(solid))])
        coded = pc.dictionary_encode(words)
        number = pc.index_in(coded.dictionary, value_set=self.known)
        if number.null_count:
            if len(self.known) + number.null_count > CACHE_WORDS:
                self.forget()
                number = pc.index_in(coded.dictionary, value_set=self.known)
            new = pc.is_null(number).to_numpy(zero_copy_only=False)
            number = number.fill_null(0).to_numpy().copy()
            number[new] = self._learn(coded.dictionary.filter(pa.array(new)))
        else:
            number = number.to_numpy()
        at = number.astype(np.int64)[coded.indices.to_numpy()] if len(n) else np.zeros(0, np.int64)
        counts = self.starts[at + 1] - self.starts[at]
        sums = np.concatenate([[0], np.cumsum(counts)])
        ids = self.flat[np.arange(sums[-1]) + np.repeat(self.starts[at] - sums[:-1], counts)]
        return ids, np.diff(sums[first])


def words_of(path: str) -> Words:
    """The worker's word cache for a tokenizer, kept between its tasks."""
    kept = sys.modules.setdefault("_docweave_token_files", types.ModuleType("_docweave_token_files")).__dict__
    if path not in kept:
        kept[path] = Words(path)
    return kept[path]


def _crc(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes(), before)


class Writer:
    """One file; texts' ids are added in order."""

    def __init__(self, out):
        self.out = out
        self.size, self.ids, self.waiting, self.held = 0, 0, [], 0
        self.docs: list = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs += zip(doc_ids, lengths.tolist(), strict=True)
        self.ids += len(ids)
        step = BLOCK_IDS * LANES
        for a in range(0, len(ids), step):
            self.waiting.append(ids[a:a + step])
            self.held += len(self.waiting[-1])
            while self.held >= step:
                self._code(step)

    def _code(self, most: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        now, rest = ids[:most], ids[most:]
        self.waiting, self.held = [rest], len(rest)
        blocks = [now[a:a + BLOCK_IDS] for a in range(0, len(now), BLOCK_IDS)]
        if not blocks:
            return
        for block, data in zip(blocks, range_coder.encode(blocks), strict=True):
            self._put(struct.pack("<III", len(block), len(data), _crc(block)) + data)

    def close(self) -> None:
        self._code(self.held)
        known = np.array([d is not None for d, _ in self.docs], np.uint8)
        table = zlib.compress(known.tobytes() + np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
                              + np.array([n for _, n in self.docs], "<i8").tobytes())
        at = self.size
        self._put(table + struct.pack("<QIII", at, len(table), zlib.crc32(table), len(self.docs)) + MAGIC)
        self.out.close()


def read_file(file, size: int):
    """``(doc_id, ids)`` pieces in order: a document's ids come in one or more
    pieces, the last of which is marked.  Damage raises ValueError."""
    tail = struct.calcsize("<QIII") + len(MAGIC)
    file.seek(size - tail)
    raw = file.read(tail)
    at, table_bytes, table_crc, n = struct.unpack_from("<QIII", raw)
    if raw[-len(MAGIC):] != MAGIC:
        raise ValueError("not a whole token file")
    file.seek(at)
    table = file.read(table_bytes)
    if zlib.crc32(table) != table_crc:
        raise ValueError("the documents' table is damaged")
    table = zlib.decompress(table)
    known, doc_ids, lengths = np.frombuffer(table, np.uint8, n), np.frombuffer(table, "<i8", n, n), np.frombuffer(table, "<i8", n, 9 * n)
    file.seek(0)
    if file.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    offset = len(MAGIC)
    doc, left = 0, int(lengths[0]) if n else 0
    while offset < at:
        data, counts, crcs, first = [], [], [], offset
        while offset < at and len(data) < LANES:
            count, size_, crc = struct.unpack("<III", file.read(12))
            if count > BLOCK_IDS or size_ > 8 * BLOCK_IDS + 64 or offset + 12 + size_ > at:
                raise ValueError(f"block {len(data)} after byte {first} is damaged")
            data.append(file.read(size_))
            counts.append(count)
            crcs.append(crc)
            offset += 12 + size_
        for i, (block, crc) in enumerate(zip(range_coder.decode(data, counts), crcs, strict=True)):
            if _crc(block) != crc:
                raise ValueError(f"block {i} after byte {first} is damaged")
            a = 0
            while a < len(block):
                piece = block[a:a + left]
                a, left = a + len(piece), left - len(piece)
                yield (int(doc_ids[doc]) if known[doc] else None), piece, left == 0
                if left == 0:
                    doc += 1
                    left = int(lengths[doc]) if doc < n else 0
    if doc != n:
        raise ValueError("ids are missing")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write all texts' ids, each with ``end_id`` after it, to ``folder`` in order
    of the id; the manifest ``(part, path, bytes, docs, tokens)``.

    A null text is empty; rows without an id come first; rows that repeat an id
    follow each other, by text.  Files are named anew at each attempt and the
    manifest names those of the attempts that succeeded.
    """
    spark = docs.sparkSession
    order = [F.col("id"), F.xxhash64("text"), F.col("row")]
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2)
    ranged = src.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")

    def run(batches):
        use, writer, path = words_of(tokenizer), None, None
        for batch in batches:
            sizes = np.diff(textarrays.text_bytes(batch.column(1))[1])
            for a, b in textarrays.slices(sizes, SLICE_BYTES):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.tokens"
                    store, local = common.open_store(path)
                    store.create_dir(local.rpartition("/")[0], recursive=True)
                    writer = Writer(store.open_output_stream(local, compression=None))
                ids, counts = use.encode(batch.column(1).slice(a, b - a))
                ends = np.cumsum(counts)
                writer.add(batch.column(0).slice(a, b - a).to_pylist(), np.insert(ids, ends, end_id), counts + 1)
        rows = []
        if writer is not None:
            writer.close()
            rows = [{"part": TaskContext.get().partitionId(), "path": path, "bytes": writer.size, "docs": len(writer.docs), "tokens": writer.ids}]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return common.written(ranged.mapInArrow(run, "part int, path string, bytes long, docs long, tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files of
    a manifest, and ``ids`` if asked.  ``start`` counts the ids of all documents
    before it; the crc32 is of the ids as little-endian u32."""
    # One row per file.
    starts = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    spark = manifest.sparkSession
    files = starts.select("path", "bytes", "start").repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows, start, crc, n, pieces, held = [], r["start"], 0, 0, [], 0
                store, local = common.open_store(r["path"])
                with store.open_input_file(local) as file:
                    for doc, piece, done in read_file(file, r["bytes"]):
                        crc, n = _crc(piece, crc), n + len(piece)
                        if with_ids:
                            pieces.append(piece)
                        if done:
                            row = {"doc_id": doc, "start": start, "n_tokens": n, "ids_crc32": crc}
                            if with_ids:
                                row["ids"] = np.concatenate(pieces).astype(np.int32)
                            rows.append(row)
                            start, held, crc, n, pieces = start + n, held + n, 0, 0, []
                            if len(rows) >= 10_000 or held > 4_000_000 and with_ids:
                                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                                rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to token files and read back."""
    import public_tokenizers as public

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_token_files(docs, common.shared_folder(spark, "tokens"), public.path("word_bpe_49k.json"))
    return read_token_files(manifest)


common.by_value(__name__)
