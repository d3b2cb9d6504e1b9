"""Byte-level BPE encoding and decoding with recursive DuckDB queries in tasks.

Spark splits the texts into words (the pre-tokenizer's pattern, on the JVM) and
deals them to tasks.  A task gives the different words of a slice of its rows to
DuckDB, as rows (word, position, token).  The recursive query joins neighbouring
tokens with the merge table and contracts, in each word, the leftmost pair of
minimum rank, until no word has a pair.  The words' ids are then put back in the
documents' order.  Decoding joins tokens with the vocabulary and aggregates the
pieces in order.

Memory per task: a slice of at most SLICE_WORDS words (or one document), of whose
new words at most LEARN_WORDS at a time go to DuckDB, and caches of at most
CACHE_WORDS words to encode and as many runs to decode, each of CACHE_BYTES at
most (or one slice's), as Arrow and numpy arrays, that a worker keeps between tasks.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common

#: Words (with repeats) that a task handles at a time.
SLICE_WORDS = 500_000
#: Different words encoded by one query.
LEARN_WORDS = 20_000
#: Different words a worker remembers; beyond, it forgets all and starts anew.
CACHE_WORDS = 600_000
CACHE_BYTES = 12 << 20
DUCKDB_MEMORY = "200MB"

ENCODE = """
WITH RECURSIVE t(word, pos, tok, live) AS (
  SELECT word, pos, tok, true FROM init
  UNION ALL
  (WITH pairs AS (
     SELECT word, pos, tok, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos
     FROM t WHERE live WINDOW w AS (PARTITION BY word ORDER BY pos)
   ), best AS (
     SELECT word, min(struct_pack(rank := merges.rank, pos := pos, gone := next_pos)) AS m
     FROM pairs JOIN merges ON tok = merges.a AND next_tok = merges.b GROUP BY word
   )
   SELECT pairs.word, pos, CASE WHEN m.pos = pos THEN m.rank ELSE tok END, m IS NOT NULL
   FROM pairs LEFT JOIN best USING (word) WHERE m IS NULL OR pos <> m.gone)
)
SELECT word, tok FROM t WHERE NOT live ORDER BY word, pos
"""

DECODE = """
SELECT run, string_agg(piece, '' ORDER BY pos) AS text FROM rows JOIN vocab USING (id) GROUP BY run ORDER BY run
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """A file of ``base64(token) rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The pre-tokenizer's pattern for the JVM: ``\\s`` is Unicode's there too."""
    return "(?U)" + pattern


class Codec:
    """One vocabulary in one DuckDB of the worker's own, in memory."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = load_ranks(path)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "allocator_flush_threshold": "8MB"})
        cut = [(self.ranks.get(t[:i]), self.ranks.get(t[i:]), r) for t, r in self.ranks.items() for i in range(1, len(t))]
        cut = [x for x in cut if x[0] is not None and x[1] is not None]
        self._table("merges", {k: pa.array([x[i] for x in cut], pa.int32()) for i, k in enumerate(("a", "b", "rank"))})
        # A byte is the character of its number, so that every piece is valid text.
        self._table("vocab", {"id": pa.array(list(self.ranks.values()), pa.int32()), "piece": pa.array([t.decode("latin-1") for t in self.ranks])})
        self.spaced = np.zeros(max(self.ranks.values()) + 1, bool)
        self.spaced[[r for t, r in self.ranks.items() if t[:1] in b" \n"]] = True
        self.forget()

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("new_rows", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM new_rows")
        self.db.unregister("new_rows")

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.runs = self.texts = pa.array([], pa.large_binary())

    def _learn(self, words: pa.Array) -> None:
        """Encode words and remember them under the next numbers."""
        parts = [self._encode_words(words.slice(a, LEARN_WORDS).to_pylist()) for a in range(0, len(words), LEARN_WORDS)]
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([c for c, _ in parts]))])
        self.flat = np.concatenate([self.flat, *(f for _, f in parts)])
        self.known = pa.concat_arrays([self.known, words])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids."""
        raw = [w.encode() for w in words]
        whole = np.array([self.ranks.get(b, -1) for b in raw], np.int64)
        sizes = np.array([len(b) for b in raw], np.int64)
        rest = np.flatnonzero(whole < 0)
        joined = np.frombuffer(b"".join(raw[i] for i in rest), np.uint8)
        n = sizes[rest]
        first = np.cumsum(n) - n
        init = pa.table({"word": np.repeat(rest, n).astype(np.int32), "tok": self.byte_ids[joined],
                         "pos": (np.arange(len(joined)) - np.repeat(first, n)).astype(np.int32)})
        self.db.register("init", init)
        out = self.db.sql(ENCODE).to_arrow_table()
        self.db.unregister("init")
        word = np.concatenate([out["word"].to_numpy().astype(np.int64), np.flatnonzero(whole >= 0)])
        tok = np.concatenate([out["tok"].to_numpy(), whole[whole >= 0].astype(np.int32)])
        return np.bincount(word, minlength=len(words)), tok[np.argsort(word, kind="stable")]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in order, and how many each word has."""
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        coded = pc.dictionary_encode(words)
        number = pc.index_in(coded.dictionary, value_set=self.known)
        if number.null_count:
            if len(self.known) + number.null_count > CACHE_WORDS or self.known.nbytes > CACHE_BYTES:
                self.known = pa.array([], pa.string())
                self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
                number = pc.index_in(coded.dictionary, value_set=self.known)
            self._learn(coded.dictionary.filter(pc.is_null(number)))
            number = pc.index_in(coded.dictionary, value_set=self.known)
        starts, flat = self.starts, self.flat
        at = number.to_numpy().astype(np.int64)[coded.indices.to_numpy()]
        counts = starts[at + 1] - starts[at]
        before = np.cumsum(counts) - counts
        ids = flat[np.arange(counts.sum()) + np.repeat(starts[at] - before, counts)]
        return ids, counts

    def _decode_runs(self, runs: pa.Array) -> pa.Array:
        """The bytes of each run of little-endian ids."""
        lengths = pc.binary_length(runs).to_numpy() // 4
        flat = np.frombuffer(b"".join(runs.to_pylist()), "<i4")
        start = np.cumsum(lengths) - lengths
        self.db.register("rows", pa.table({"run": np.repeat(np.arange(len(runs), dtype=np.int32), lengths), "id": flat,
                                           "pos": (np.arange(len(flat)) - np.repeat(start, lengths)).astype(np.int32)}))
        out = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("rows")
        return pa.array([t.encode("latin-1") for t in out["text"].to_pylist()], pa.large_binary())

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of id sequences that end at ``ends``.  Each is cut into runs
        before ids that begin with white space; new runs are decoded, and remembered."""
        if not len(ids):
            return [b""] * len(ends)
        cuts = np.zeros(len(ids), bool)
        cuts[self.spaced[ids]] = True
        cuts[0] = True
        cuts[ends[ends < len(ids)]] = True
        first = np.flatnonzero(cuts)
        runs = pa.Array.from_buffers(pa.large_binary(), len(first), [
            None, pa.py_buffer((np.append(first, len(ids)) * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids, "<i4"))])
        coded = pc.dictionary_encode(runs)
        number = pc.index_in(coded.dictionary, value_set=self.runs)
        if number.null_count:
            if len(self.runs) + number.null_count > CACHE_WORDS or self.runs.nbytes > CACHE_BYTES:
                self.runs = self.texts = pa.array([], pa.large_binary())
                number = pc.index_in(coded.dictionary, value_set=self.runs)
            fresh = coded.dictionary.filter(pc.is_null(number))
            self.texts = pa.concat_arrays([self.texts, self._decode_runs(fresh)])
            self.runs = pa.concat_arrays([self.runs, fresh])
            number = pc.index_in(coded.dictionary, value_set=self.runs)
        pieces = self.texts.take(number.take(coded.indices))
        data = np.frombuffer(pieces.buffers()[2], np.uint8) if pieces.buffers()[2] else np.zeros(0, np.uint8)
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[:len(first) + 1]
        at = offsets[np.searchsorted(first, np.concatenate([[0], ends]))]
        return [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def codec(path: str) -> Codec:
    """The worker's codec for a vocabulary, kept between its tasks."""
    kept = sys.modules.setdefault("_docweave_byte_bpe", types.ModuleType("_docweave_byte_bpe")).__dict__
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


def _slices(counts: np.ndarray):
    """Row ranges of at most SLICE_WORDS words, or of one row."""
    start, total = 0, 0
    for i, n in enumerate(counts):
        if i > start and total + n > SLICE_WORDS:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(counts):
        yield start, len(counts)


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def _id_lists(path: str, lists):
    """``(row ranges, ids, ends of rows in ids)`` of an Arrow list of words."""
    use = codec(path)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for a, b in _slices(sizes):
        part = lists.slice(a, b - a)
        ids, counts = use.encode(part.flatten())
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes[a:b])]
        yield (a, b), ids, ends
    common.give_back()


def encode(docs: DataFrame, vocab: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``, the ids of the whole text without special
    tokens; null and empty texts have none.  A column of that name is replaced,
    all others stay; rows that repeat are encoded each."""
    return _encoded(docs, vocab, pattern, text_col, ids_col, None)


def round_trip(docs: DataFrame, vocab: str, pattern: str, text_col: str = "text", ids_col: str = "ids", whole_col: str = "decodes") -> DataFrame:
    """``docs`` with ``ids_col`` as ``encode`` gives it and ``whole_col``, whether
    these ids decode to the text, both in one stage; columns of these names are
    replaced, all others stay."""
    return _encoded(docs, vocab, pattern, text_col, ids_col, whole_col)


def _encoded(docs: DataFrame, vocab: str, pattern: str, text_col: str, ids_col: str, whole_col: str | None) -> DataFrame:
    text, words = common.free_name(docs, "text_"), common.free_name(docs, "words_")
    src = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(words, split_words(F.col(text_col), pattern))
    # The new columns may replace any of the old ones, the text too.
    kept = [c for c in docs.columns if c not in (ids_col, whole_col)]
    extra = [f"`{ids_col}` array<int>"] + ([f"`{whole_col}` boolean"] if whole_col else [])
    src = src.select(*kept, words, *([text] if whole_col else []))

    def run(batches):
        for batch in batches:
            rest = pa.Table.from_batches([batch]).select(kept)
            for (a, b), ids, ends in _id_lists(vocab, batch.column(len(kept))):
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                out = rest.slice(a, b - a).append_column(ids_col, lists)
                if whole_col:
                    texts = batch.column(len(kept) + 1).slice(a, b - a).to_pylist()
                    back = codec(vocab).decode(ids, ends)
                    out = out.append_column(whole_col, pa.array([x == t.encode() for x, t in zip(back, texts, strict=True)], pa.bool_()))
                yield from out.combine_chunks().to_batches()

    return src.mapInArrow(run, common.ddl(docs.select(*kept), *extra))


def decode(rows: DataFrame, vocab: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col``, the bytes that the ids stand for; null ids are
    an empty list.  An id that the vocabulary lacks is an error."""
    rows = rows.drop(out_col)

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lists = pc.fill_null(batch.column(batch.schema.get_field_index(ids_col)), pa.scalar([], pa.list_(pa.int32())))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for a, b in _slices(sizes):
                ids = lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(codec(vocab).spaced)):
                    raise ValueError("an id is not in the vocabulary")
                data = codec(vocab).decode(ids, np.cumsum(sizes[a:b]))
                yield from table.slice(a, b - a).append_column(out_col, pa.array(data, pa.binary())).combine_chunks().to_batches()

    return rows.mapInArrow(run, common.ddl(rows, f"`{out_col}` binary"))


def digests(docs: DataFrame, vocab: str, pattern: str, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: every text encoded and
    the ids decoded again in the same task."""
    src = docs.select(key, text_col).select(F.col(key).alias("key"), split_words(F.col(text_col), pattern).alias("words"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for (a, b), ids, ends in _id_lists(vocab, batch.column("words")):
                raw = np.ascontiguousarray(ids, "<u4")
                first = np.append(0, ends)
                back = codec(vocab).decode(ids, ends)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").slice(a, b - a), pa.array(np.diff(first), pa.int64()),
                    pa.array([hashlib.sha256(raw[x:y].tobytes()).hexdigest() for x, y in zip(first[:-1], first[1:], strict=True)]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back])], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    import public_tokenizers as public

    docs = common.spread(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return digests(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


common.by_value(__name__)
