"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent in numpy, with rejection.

A text's subwords are the 1- to 4-grams of its words in lower case, with marks
at the words' ends.  Each hashes to one of BUCKETS embeddings; their mean goes
through a linear layer and a softmax.  After training the two are multiplied
out: a subword adds one number per language.

The model is fitted on the driver on at most TRAIN_ROWS labelled rows, those of
the smallest id hashes, whose subword counts (at most BUCKETS each) the
executors make.  A part of them is kept from the training to calibrate: the
softmax's temperature, and two limits beyond which a text is rejected, its
score and its share of subwords that training never saw.
"""

from __future__ import annotations

import sys
import types
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common, textarrays

#: Bounds of the fit.
TRAIN_ROWS = 4000
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 4
RATE = 0.5
CALIBRATION_SHARE = 0.2
#: Extra training examples: so many runs of SNIPPET_WORDS words of each text.
SNIPPETS = 3
SNIPPET_WORDS = (3, 8)
#: Rejection: at most this share of rightly labelled calibration texts, and
#: never a text with this score and fewer unseen subwords than UNSEEN_LEAST.
REJECT_SHARE = 0.002
REJECT_SCORE = 0.5
UNSEEN_LEAST = 0.5
NGRAMS = (1, 2, 3, 4)
SLICE_CHARS = 1 << 19
UNDETERMINED = "und"


@dataclass
class Model:
    langs: list[str]
    #: A row per bucket: a number per language, then 1 if training never saw it;
    #: the last row, of what is no subword, is zero.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float
    most_unseen: float


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    kept = sys.modules.setdefault("_docweave_letters", types.ModuleType("_docweave_letters")).__dict__
    if "letters" not in kept:
        kept["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return kept["letters"]


def subwords(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram length the buckets (BUCKETS where there is no subword) of
    all positions, and the positions where each text begins and ends."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum([0] + [len(t) + 1 for t in lower])
    code = np.where(_letters()[points], points, 0)
    # One mark stands for a run of other characters; each text begins with one.
    keep = np.empty(len(code), bool)
    keep[0], keep[1:] = True, (code[1:] != 0) | (code[:-1] != 0)
    keep[begin] = True
    code = code[keep].astype(np.uint64)
    first = np.cumsum(keep)[begin] - 1
    mark, out = code == 0, []
    h, valid = np.zeros(len(code), np.uint64), np.ones(len(code), bool)
    for n in range(1, max(NGRAMS) + 1):
        m = len(code) - n + 1
        if m <= 0:
            out.append(np.full(len(code), BUCKETS, np.int64))
            continue
        if n > 2:
            valid[:m] &= ~mark[n - 2:n - 2 + m]
        h[:m] = (h[:m] + code[n - 1:n - 1 + m] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        ok = valid[:m] & (~mark[:m] if n == 1 else ~(mark[:m] & mark[n - 1:n - 1 + m]) if n == 2 else True)
        bucket = np.full(len(code), BUCKETS, np.int64)
        bucket[:m] = np.where(ok, ((h[:m] ^ np.uint64(n)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(48), BUCKETS)
        out.append(bucket)
    return out, first


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and shares of each text's subwords."""
    grams, first = subwords(texts)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        ids = np.concatenate([g[a:b] for g in grams])
        ids, n = np.unique(ids[ids < BUCKETS], return_counts=True)
        out.append((ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


def _snippets(text: str, seed: int) -> list[str]:
    words = text.split()
    rng = np.random.default_rng(seed)
    if len(words) <= SNIPPET_WORDS[1]:
        return []
    return [" ".join(words[a:a + n]) for a, n in zip(rng.integers(0, len(words) - SNIPPET_WORDS[1], SNIPPETS),
                                                      rng.integers(SNIPPET_WORDS[0], SNIPPET_WORDS[1] + 1, SNIPPETS), strict=True)]


def training_bags(docs: DataFrame, usable: Column) -> list:
    """Rows ``(lang, calibrate, buckets, shares)`` of the sample and its snippets."""
    rank = F.xxhash64(F.col("doc_id").cast("string"), F.lit(2))
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(rank.alias("rank"), "lang", "text")
    last = rows.select("rank").orderBy("rank").limit(TRAIN_ROWS).agg(F.max("rank")).first()[0]
    if last is None:
        return []
    # The limit gathers the sample in one partition; it is dealt out again.
    sample = rows.where(F.col("rank") <= last).limit(TRAIN_ROWS).repartition(docs.sparkSession.sparkContext.defaultParallelism * 2)

    def run(batches):
        for batch in batches:
            got = {k: [] for k in ("rank", "lang", "whole", "buckets", "shares")}
            for rank, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for i, (ids, share) in enumerate(bags([text, *_snippets(text, rank % 2**32)])):
                    if len(ids):
                        for k, v in zip(got, (rank, lang, i == 0, ids, share), strict=True):
                            got[k].append(v)
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema([
                ("rank", pa.int64()), ("lang", pa.string()), ("whole", pa.bool_()), ("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))]))

    rows = sample.mapInArrow(run, "rank long, lang string, whole boolean, buckets array<int>, shares array<float>").toArrow()
    order = np.lexsort((~rows["whole"].to_numpy(), rows["rank"].to_numpy()))
    lists = {k: rows[k].combine_chunks() for k in ("buckets", "shares")}
    langs, ranks = rows["lang"].to_pylist(), rows["rank"].to_numpy()
    return [(langs[i], ranks[i] % 1000 < 1000 * CALIBRATION_SHARE, *(lists[k][i].values.to_numpy() for k in lists)) for i in order]


def fit(examples: list, seed: int = 0) -> Model | None:
    """The model of ``(lang, calibrate, buckets, shares)``; None without any."""
    langs = sorted({e[0] for e in examples})
    if not langs:
        return None
    number = {x: i for i, x in enumerate(langs)}
    train = [e for e in examples if not e[1]] or examples
    check = [e for e in examples if e[1]] or examples
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(train)):
            lang, _, ids, share = train[i]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = emb[ids]
            mean = share @ rows
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[number[lang]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # Normalised: the mean itself moves by the rate, however many subwords share the step.
            emb[ids] = rows - (rate * share / float(share @ share))[:, None] * back
    seen = np.zeros(BUCKETS, bool)
    for _, _, ids, _ in train:
        seen[ids] = True
    table = np.zeros((BUCKETS + 1, len(langs) + 1), np.float32)
    table[:BUCKETS, :-1] = emb @ out
    table[:BUCKETS, -1] = ~seen
    z = np.array([share @ table[ids] for _, _, ids, share in check])
    right = np.array([number[e[0]] for e in check])
    logits, unseen = z[:, :-1] + bias, z[:, -1]
    losses = {}
    for t in np.geomspace(0.05, 20, 60):
        s = logits / t
        s -= s.max(1, keepdims=True)
        losses[t] = np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), right])
    best = min(losses, key=losses.get)
    s = np.exp((logits - logits.max(1, keepdims=True)) / best)
    score, hit = s.max(1) / s.sum(1), s.argmax(1) == right
    hits = score[hit] if hit.any() else np.ones(1)
    return Model(langs, table, bias, float(best), float(min(REJECT_SCORE, np.quantile(hits, REJECT_SHARE))),
                 float(max(UNSEEN_LEAST, np.quantile(unseen, 1 - REJECT_SHARE))))


def score_texts(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether it is rejected, of each text."""
    full = [t or "" for t in texts]
    langs, scores, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    if model is None or not full:
        return langs, scores, rejected
    grams, first = subwords(full)
    total, count = np.zeros((len(full), model.table.shape[1])), np.zeros(len(full))
    for g in grams:
        total += np.add.reduceat(model.table[g], first[:-1], axis=0, dtype=np.float64)
        count += np.add.reduceat((g < BUCKETS).astype(np.int64), first[:-1])
    some = count > 0
    mean = total / np.maximum(count, 1)[:, None]
    z = (mean[:, :-1] + model.bias) / model.temperature
    p = np.exp(z - z.max(1, keepdims=True))
    scores = np.where(some, p.max(1) / p.sum(1), 0.0)
    langs = [model.langs[i] if ok else UNDETERMINED for i, ok in zip(z.argmax(1), some, strict=True)]
    return langs, scores, ~some | (scores < model.least_score) | (mean[:, -1] > model.most_unseen)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text",
             out: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``, under the names
    ``out`` (columns of these names are replaced, others stay).

    A text that is null or has no letter is ``und`` with score 0, rejected.
    Without a model (no labelled row) every text is.  The whole text counts,
    however long; texts that repeat get equal answers; rows need no id.
    """
    docs = docs.drop(*out)
    at, names = docs.columns.index(text_col), [*docs.columns, *out]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{n}` {t}" for n, t in zip(out, ("string", "double", "boolean"), strict=True)])

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for a, b in textarrays.slices(sizes, SLICE_CHARS):
                part = batch.slice(a, b - a)
                langs, scores, rejected = score_texts(model, part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
                                                 names=names)
        common.give_back()

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, usable: Column | None = None) -> Model | None:
    """Fit on the rows of ``(doc_id, text, lang)`` that are ``usable``."""
    return fit(training_bags(docs, F.lit(True) if usable is None else usable))


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, ~common.held_out("doc_id"))
    found = identify(common.spread(docs.select("doc_id", "text")), model)
    return found.select("doc_id", common.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


common.by_value(__name__)
