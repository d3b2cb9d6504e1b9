"""Quality classifier: nearest-neighbour voting among labelled texts in a latent
semantic space.

A text becomes counts of hashed terms: its words, the shapes of its words, and a
few facts of the whole text (how much of it repeats, and how long it is).  Log
counts are weighted by inverse document frequency, and a truncated singular
value decomposition of the labelled sample gives DIMENSIONS latent axes.  The
labelled vectors go to every task; exact cosines of each block of texts with all
of them are one matrix product, and the NEIGHBOURS nearest vote with their
similarity as weight.

The sample is the LABELLED_ROWS usable labelled rows of the smallest id hashes:
a bound on what is fitted, collected and broadcast (LABELLED_ROWS x DIMENSIONS
and TERMS x DIMENSIONS numbers).  Every text is scored, and whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays

#: Bounds of the fit.
LABELLED_ROWS = 3000
WORD_TERMS, SHAPE_TERMS, FACT_TERMS = 4096, 1024, 64
TERMS = WORD_TERMS + SHAPE_TERMS + FACT_TERMS
DIMENSIONS = 64
NEIGHBOURS = 25
#: Similarities are raised to this power as weights.
SHARPNESS = 8
#: How much each kind of term counts (each kind has unit length before).
WEIGHTS = (0.4, 1.0, 0.6)
PREDICT_FROM = 0.3
SLICE_BYTES = 4 << 20
BLOCK = 128

#: A byte's class in a word's shape: a-z, A-Z, 0-9, any byte of other letters, else itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = 97, 65, 48, 97


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes: classes with runs of one class cut to one."""
    cls = SHAPE[data]
    keep = np.ones(len(cls), bool)
    keep[1:] = cls[1:] != cls[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return textarrays.hash_runs(cls[keep], at[starts], at[ends])



def term_counts(texts: pa.Array, begin: int, end: int, cache: dict) -> np.ndarray:
    """Counts of all terms for the texts ``begin..end`` of a slice."""
    if not cache:
        data, offsets = textarrays.text_bytes(texts)
        starts, ends, first = textarrays.words(data, offsets)
        low = textarrays.hash_runs(textarrays.LOWER[data], starts, ends)
        cache.update(first=first, word=low, shape=_shapes(data, starts, ends), size=np.diff(offsets))
    first, out = cache["first"], np.zeros((end - begin, TERMS), np.float32)
    a, b = first[begin], first[end]
    row = np.repeat(np.arange(end - begin), np.diff(first[begin:end + 1]))
    for hashes, base, n in ((cache["word"], 0, WORD_TERMS), (cache["shape"], WORD_TERMS, SHAPE_TERMS)):
        term = (hashes[a:b] % np.uint64(n)).astype(np.int64)
        out[:, base:base + n] = np.bincount(row * n + term, minlength=len(out) * n).reshape(len(out), n)
    for i in range(begin, end):
        w = cache["word"][first[i]:first[i + 1]]
        pairs = w[:-1] * np.uint64(3) + w[1:]
        facts = [
            (0, len(np.unique(w)) / max(1, len(w))), (10, len(np.unique(pairs)) / max(1, len(pairs))),
            (20, float(np.mean(w[1:] == w[:-1])) if len(w) > 1 else 0.0)]
        for at, share in facts:
            out[i - begin, WORD_TERMS + SHAPE_TERMS + at + min(int(share * 10), 9)] = 1
        out[i - begin, WORD_TERMS + SHAPE_TERMS + 30 + min(int(len(w) + 1).bit_length(), 32)] = 1
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts by inverse document frequency, each kind of unit length times its weight."""
    x = np.log1p(counts) * idf
    at = 0
    for n, w in zip((WORD_TERMS, SHAPE_TERMS, FACT_TERMS), WEIGHTS, strict=True):
        part = x[:, at:at + n]
        part *= w / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
        at += n
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(counts: np.ndarray, labels: np.ndarray, seed: int = 0) -> Model:
    """Latent axes by a randomised truncated decomposition, and the sample's vectors."""
    n = len(counts)
    idf = (np.log((1 + n) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
    x = weigh(counts, idf)
    rng = np.random.default_rng(seed)
    basis = x @ rng.standard_normal((TERMS, min(DIMENSIONS + 16, n))).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(basis)
        basis, _ = np.linalg.qr(x.T @ basis)
        basis = x @ basis
    basis, _ = np.linalg.qr(basis)
    _, _, right = np.linalg.svd(basis.T @ x, full_matrices=False)
    axes = np.ascontiguousarray(right[:DIMENSIONS].T, np.float32)
    return Model(idf, axes, _unit(x @ axes).astype(np.float32), labels.astype(np.float32))


def vote(model: Model, counts: np.ndarray) -> np.ndarray:
    """The weighted share of label 1 among the nearest labelled vectors."""
    cosines = _unit(weigh(counts, model.idf) @ model.axes) @ model.vectors.T
    k = min(NEIGHBOURS, cosines.shape[1])
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
    return np.clip((weight * model.labels[near]).sum(1) / weight.sum(1), 0.0, 1.0)


def score_texts(model: Model | None, texts: pa.Array) -> np.ndarray:
    """Scores of the texts of a batch; 0.5 without a model."""
    if model is None or not len(texts):
        return np.full(len(texts), 0.5)
    sizes = np.diff(textarrays.text_bytes(texts)[1])
    out = []
    for a, b in textarrays.slices(sizes, SLICE_BYTES):
        part, cache = texts.slice(a, b - a), {}
        for i in range(0, b - a, BLOCK):
            out.append(vote(model, term_counts(part, i, min(i + BLOCK, b - a), cache)))
    return np.concatenate(out)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most LABELLED_ROWS rows, by id hash."""
    rank = F.xxhash64(F.col("doc_id").cast("string"), F.lit(5))
    known = (labels.where(usable & F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("label"))
             .orderBy(rank, "doc_id").limit(LABELLED_ROWS))
    sample = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))

    def run(batches):
        for batch in batches:
            texts, cache, got = batch.column(0), {}, {"label": [], "terms": [], "counts": []}
            for i in range(len(texts)):
                row = term_counts(texts, i, i + 1, cache)[0]
                at = np.flatnonzero(row)
                for k, v in zip(got, (batch.column(1)[i].as_py(), at, row[at]), strict=True):
                    got[k].append(v)
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([("label", pa.int32()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))]))

    rows = sample.orderBy(rank, "doc_id").select("text", "label").mapInArrow(run, "label int, terms array<int>, counts array<float>").toArrow()
    counts = np.zeros((len(rows), TERMS), np.float32)
    terms, values = rows["terms"].combine_chunks(), rows["counts"].combine_chunks()
    for i in range(len(rows)):
        counts[i, terms[i].values.to_numpy()] = values[i].values.to_numpy()
    return counts, rows["label"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", usable: Column | None = None) -> Model | None:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, 0 or 1); None
    if no usable row has a label and a text row.  Of labels or texts that repeat
    for an id the smallest counts."""
    counts, y = labelled_sample(docs.select("doc_id", "text"), labels, label_col, F.lit(True) if usable is None else usable)
    return fit(counts, y) if len(y) else None


def classify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (columns of these names are
    replaced, others stay).  Null is an empty text and gets a score too; equal
    texts get equal scores; without a model every score is 0.5."""
    docs = docs.drop("score", "predicted")
    at, names = docs.columns.index(text_col), [*docs.columns, "score", "predicted"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["score double", "predicted int"])

    def run(batches):
        for batch in batches:
            scores = score_texts(model, batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= PREDICT_FROM).astype(np.int32))], names=names)

    return docs.mapInArrow(run, schema)


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"), usable=~common.held_out("doc_id"))
    return classify(common.spread(docs), model).select("doc_id", common.held_out("doc_id").alias("held_out"), "score", "predicted")


common.by_value(__name__)
