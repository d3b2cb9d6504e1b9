"""Alignment of two tokenizers' ids over the same bytes.

Every text is encoded by a byte-level BPE (A) and a sentence-piece model (B).
Both cover the bytes of a space and the text.  The tokens of a slice of texts,
of A and B alike, are sorted by their start; the running maximum of their ends
tells where a group breaks: where a start reaches it.  Within groups each A
token is expanded to the B tokens that overlap it.

Neither tokenizer has a token that goes on from a character other than white
space into a space, so a text is cut there, and a word's ids are remembered.

The pairs of linked ids are counted over all documents.  Those that hold at
least one COMMON-th of all links, so at most COMMON pairs, are broadcast to the
documents; the rest, none of which is frequent, are joined by shuffle.
"""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays

#: Bytes of text aligned at a time, or one text.
SLICE_BYTES = 2 << 20
#: What a worker remembers of words; beyond, it forgets all.
CACHE_WORDS, CACHE_BYTES = 600_000, 16 << 20
#: New words encoded as one text.
LEARN_WORDS = 2000
#: The greatest number of broadcast pairs.
COMMON = 1 << 18
#: First bytes of characters among which are white spaces other than ASCII's.
WIDE_SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)


def byte_tokens(tokenizer) -> list[bytes]:
    """The bytes of a byte-level vocabulary's entries, by id."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


def piece_tokens(model) -> list[bytes]:
    """The bytes of a sentence-piece vocabulary's entries, by id; control
    entries have none."""
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        none = model.is_control(i) or model.is_unknown(i)
        out.append(b"" if none else bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def _may_end(data: np.ndarray) -> np.ndarray:
    """Whether a byte ends a character that is no white space, as far as its
    first byte tells."""
    lead = np.maximum.accumulate(np.where((data < 0x80) | (data >= 0xC0), np.arange(len(data)), 0))
    return (data > 32) & (data != 127) & ~np.isin(data[lead], WIDE_SPACE_LEADS)


def cut_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words start in texts that each begin with a space: at each text and
    at each space, or run of them, that stands between other characters."""
    cut = data == 32
    cut[1:] &= _may_end(data)[:-1]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    cut |= begins[:-1]
    # A run of white space that ends its text stays with the word before.
    solid = np.flatnonzero(data > 32)
    last = np.full(len(offsets) - 1, -1)
    upto = np.searchsorted(solid, offsets[1:]) - 1
    has = (upto >= 0) & (np.diff(offsets) > 0)
    last[has] = solid[upto[has]]
    at = np.flatnonzero(cut)
    text = np.searchsorted(offsets, at, "right") - 1
    return at[begins[at] | (at < last[text])]


class Pair:
    """Both tokenizers and the ids of the words seen, in a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes = [pa.array(t, pa.large_binary()) for t in (byte_tokens(self.a), piece_tokens(self.b))]
        self.sizes = [pc.binary_length(t).to_numpy() for t in self.bytes]
        most = max(len(t) for t in self.bytes)
        #: Decimal ids followed by what separates them from the next.
        self.decimal = pa.array([f"{i}{s}" for s in (",", "|", ";", "") for i in range(most)], pa.large_string())
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.starts = [np.zeros(1, np.int64) for _ in range(2)]
        self.flat = [np.zeros(0, np.int32) for _ in range(2)]

    def _learn(self, words: pa.Array) -> None:
        """Encode words and remember them under the next numbers."""
        data, offsets = textarrays.text_bytes(words)
        # Words that may stand before a space; they are encoded as one text.
        plain = _may_end(data)[offsets[1:] - 1]
        groups = [np.flatnonzero(plain)[a:a + LEARN_WORDS] for a in range(0, int(plain.sum()), LEARN_WORDS)] + [[i] for i in np.flatnonzero(~plain)]
        order = np.concatenate(groups).astype(np.int64)
        for k, use in enumerate((self._encode_a, self._encode_b)):
            parts = []
            for rows in groups:
                some = words.take(pa.array(rows))
                joined, ends = textarrays.text_bytes(some)
                ids, ends = np.array(use(joined.tobytes().decode()), np.int32), ends[1:]
                at = np.append(0, np.cumsum(self.sizes[k][ids]))
                upto = np.searchsorted(at, ends)
                if len(some) > 1 and not (at[-1] == ends[-1] and (at[np.minimum(upto, len(ids))] == ends).all()):
                    # One of them holds what the tokenizer does not give back.
                    each = [np.array(use(w), np.int32) for w in some.to_pylist()]
                    ids, upto = np.concatenate(each), np.cumsum([len(x) for x in each])
                elif len(some) == 1:
                    upto = np.array([len(ids)])
                parts.append((ids, np.diff(upto, prepend=0)))
            counts = np.concatenate([c for _, c in parts])
            self.starts[k] = np.concatenate([self.starts[k], self.starts[k][-1] + np.cumsum(counts)])
            self.flat[k] = np.concatenate([self.flat[k], *(x for x, _ in parts)])
        self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])

    def _encode_a(self, text: str) -> list[int]:
        return self.a.encode(text, add_special_tokens=False).ids

    def _encode_b(self, text: str) -> list[int]:
        """B adds the space that every word begins with."""
        return self.b.encode(text[1:])

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """For A and B: all ids of texts that begin with a space, and how many each text has."""
        at = cut_words(data, offsets)
        words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = pc.dictionary_encode(words)
        number = pc.index_in(coded.dictionary, value_set=self.known)
        if number.null_count:
            if len(self.known) + number.null_count > CACHE_WORDS or self.known.nbytes > CACHE_BYTES:
                self.forget()
                number = pc.index_in(coded.dictionary, value_set=self.known)
            self._learn(coded.dictionary.filter(pc.is_null(number)))
            number = pc.index_in(coded.dictionary, value_set=self.known)
        which = number.to_numpy().astype(np.int64)[coded.indices.to_numpy()]
        first = np.searchsorted(at, offsets)
        for starts, flat in zip(self.starts, self.flat, strict=True):
            counts = starts[which + 1] - starts[which]
            sums = np.concatenate([[0], np.cumsum(counts)])
            yield flat[np.arange(sums[-1]) + np.repeat(starts[which] - sums[:-1], counts)], np.diff(sums[first])


def tokenizers(path_a: str, path_b: str) -> Pair:
    """The worker's tokenizers, kept between its tasks."""
    kept = sys.modules.setdefault("_docweave_alignment", types.ModuleType("_docweave_alignment")).__dict__
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Pair(path_a, path_b)
    return kept[path_a, path_b]


def _whole(pair: Pair, k: int, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts the bytes of their ids make up again."""
    joined = pair.bytes[k].take(pa.array(ids))
    back = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    ends = np.concatenate([[0], np.cumsum(pair.sizes[k][ids])])[np.concatenate([[0], np.cumsum(counts)])]
    if len(back) == len(data) and (ends == offsets).all() and (back == data).all():
        return np.ones(len(counts), bool)
    return np.array([b - a == d - c and (back[a:b] == data[c:d]).all() for a, b, c, d in zip(ends[:-1], ends[1:], offsets[:-1], offsets[1:], strict=True)], bool)


def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of intervals by start, and the group of each in that order: a
    group ends where a start reaches the greatest end so far."""
    order = np.lexsort((side, start))
    s, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] >= reach[:-1]
    return order, np.cumsum(new) - 1


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(i, j)`` of all overlapping intervals of two sorted lists, each without overlaps of its own."""
    low, high = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    n = high - low
    begin = np.cumsum(n) - n
    return np.repeat(np.arange(len(n)), n), np.arange(n.sum()) + np.repeat(low - begin, n)


def align_slice(pair: Pair, texts: pa.Array) -> pa.RecordBatch:
    """One row per text: counts, the groups' hash, and the linked id pairs with how often each occurs."""
    full = pc.greater(pc.binary_length(pc.fill_null(texts, "")), 0).to_numpy(zero_copy_only=False)
    n_rows, rows = len(texts), np.flatnonzero(full)
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    spaced = pc.binary_join_element_wise(space, pc.fill_null(texts, "").cast(pa.large_string()).take(pa.array(rows)), nothing)
    data, offsets = textarrays.text_bytes(spaced)
    ids, counts = zip(*pair.encode(np.ascontiguousarray(data), offsets), strict=True)
    good = np.logical_and(*(_whole(pair, k, ids[k], counts[k], data, offsets) for k in (0, 1)))
    ids = [i[np.repeat(good, c)] for i, c in zip(ids, counts, strict=True)]
    rows, counts = rows[good], [c[good] for c in counts]
    n_texts = len(rows)
    # The texts lie behind one another, so no group goes on into the next one.
    ends = [np.cumsum(pair.sizes[k][ids[k]]) for k in (0, 1)]
    starts = [e - pair.sizes[k][ids[k]] for k, e in enumerate(ends)]
    owner = [np.repeat(np.arange(n_texts), c) for c in counts]
    side = np.repeat(np.array([0, 1], np.int8), [len(ids[0]), len(ids[1])])
    order, group = coalesce(np.concatenate(starts), np.concatenate(ends), side)
    of = np.concatenate(owner)[order]
    n_groups = np.bincount(of[np.append(True, group[1:] != group[:-1])], minlength=n_texts) if len(of) else np.zeros(n_texts, np.int64)
    # Groups in order, in each the ids of A, then of B, as decimals.
    again = np.argsort(group * 2 + side[order], kind="stable")
    last_side, last_group, last_text = (np.append(x[1:] != x[:-1], True) if len(x) else np.zeros(0, bool) for x in (side[order][again], group[again], of[again]))
    mark = np.where(last_text, 3, np.where(last_group, 2, np.where(last_side, 1, 0)))
    spelled = pair.decimal.take(pa.array(mark * pair.most + np.concatenate(ids)[order][again]))
    written, where = textarrays.text_bytes(spelled)
    edge = where[np.concatenate([[0], np.cumsum(counts[0] + counts[1])])]
    hashes = [hashlib.sha256(written[a:b]).hexdigest() for a, b in zip(edge[:-1], edge[1:], strict=True)]
    # Links, counted per text and pair of ids.
    i, j = overlaps(starts[0], ends[0], starts[1], ends[1])
    code = (owner[0][i] * pair.most + ids[0][i]) * pair.most + ids[1][j]
    code, times = np.unique(code, return_counts=True)
    text, code = np.divmod(code, pair.most * pair.most)
    a, b = np.divmod(code, pair.most)
    size = np.zeros(n_rows, np.int64)
    size[rows] = np.bincount(text, minlength=n_texts)
    lists = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())

    named = [""] * n_rows
    for k, value in zip(rows.tolist(), hashes, strict=True):
        named[k] = value

    def spread(values):
        out = np.zeros(n_rows, np.int64)
        out[rows] = values
        return pa.array(out)

    return pa.RecordBatch.from_arrays([
        spread(counts[0]), spread(counts[1]), spread(n_groups), spread(np.bincount(owner[0][i], minlength=n_texts)), pa.array(named, pa.string()),
        *(pa.ListArray.from_arrays(lists, pa.array(x.astype(np.int32))) for x in (a, b, times))],
        names=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"])


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, n_links, groups_sha256, a, b, times)`` per
    row of ``docs``, written; ``row`` is the row's own number."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            sizes = np.diff(textarrays.text_bytes(texts)[1])
            for x, y in textarrays.slices(sizes, SLICE_BYTES):
                out = align_slice(tokenizers(path_a, path_b), texts.slice(x, y - x))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), *out.columns], names=["id", *out.schema.names])
        common.give_back()

    out = src.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<int>")
    return common.written(out.withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(links: DataFrame) -> DataFrame:
    """``(a, b, count, best)``: how many links hold each pair of ids, of rows
    with lists ``a``, ``b``, ``times``, and whether no pair of the same ``b`` has more."""
    each = links.select(F.explode(F.arrays_zip("a", "b", "times")).alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.times").alias("count"))
    each = common.written(each, "pairs")
    # A row per id of B.
    most = each.groupBy("b").agg(F.max("count").alias("most"))
    return common.written(each.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "pair-counts")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, a row per row of ``docs``.

    Texts that are null or empty, or that either tokenizer's bytes don't give
    back, have no tokens: zeros and an empty hash.  Rows that repeat, also an id,
    count each; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = aligned(docs, path_a, path_b, id_col, text_col)
    counts = pair_counts(rows)
    links = rows.agg(F.sum("n_links")).first()[0] or 0
    least = max(1, -(-links // COMMON))
    # Bounded: COMMON pairs at most can hold a COMMON-th of all links each.
    table = counts.where(F.col("count") >= least).select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("code"), "count", "best").toArrow()
    order = np.argsort(table["code"].to_numpy())
    code, count, best = (table[c].to_numpy(zero_copy_only=False)[order] for c in ("code", "count", "best"))
    known = spark.sparkContext.broadcast((code, count, best.astype(bool)))
    kept = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        codes, counted, top = known.value
        for batch in batches:
            lists = [batch.column(c) for c in ("a", "b", "times")]
            a, b, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            size = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(size)), size)
            here = (a << 32) + b
            at = np.minimum(np.searchsorted(codes, here), max(len(codes) - 1, 0))
            hit = codes[at] == here if len(codes) else np.zeros(len(here), bool)
            gain, good = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            np.add.at(gain, owner[hit], times[hit] * counted[at[hit]])
            np.add.at(good, owner[hit], times[hit] * top[at[hit]])
            left = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=len(size)))]), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(good), pa.array(gain),
                                              *(pa.ListArray.from_arrays(left, pa.array(x[~hit].astype(np.int32))) for x in (a, b, times))],
                                             names=[*kept, "n_best", "count_sum", "a", "b", "times"])

    ddl = common.ddl(rows.select(*kept), "n_best long, count_sum long, a array<int>, b array<int>, times array<int>")
    some = common.written(rows.select(*kept, "a", "b", "times").mapInArrow(run, ddl), "known-pairs")
    rare = some.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.*")
    rare = rare.join(counts.where(F.col("count") < least), ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("more_best"), F.sum(F.col("times") * F.col("count")).alias("more_sum"))
    out = some.drop("a", "b", "times").join(rare, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE against sentence pieces, for every document."""
    import public_tokenizers as public

    docs = common.spread(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return align(docs, public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))


common.by_value(__name__)
