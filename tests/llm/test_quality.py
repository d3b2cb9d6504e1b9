"""Quality: held-out accuracy, exact neighbours, odd rows."""

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import common, quality

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(common.table(spark, D, "documents"), common.table(spark, D, "labels"), usable=~common.held_out("doc_id"))


def test_held_out_ranking(spark):
    rows = quality.q_op5(spark, D).join(common.table(spark, D, "labels"), "doc_id").collect()
    assert quality.q_op5(spark, D).count() == common.table(spark, D, "documents").count()
    held = [r for r in rows if r["held_out"]]
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) > 0.98
    assert np.mean([r["predicted"] for r in held if r["quality"] == 0]) < 0.3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_vote_is_exact(model):
    texts = pa.array(["That it is.", "THE!! AND!! OF!!", "a*** b*** c$$$", "", None, "the the the the"])
    counts = quality.term_counts(texts, 0, len(texts), {})
    got = quality.vote(model, counts)
    x = quality.weigh(counts, model.idf) @ model.axes
    for i in range(len(texts)):
        cos = np.array([x[i] @ v / max(np.linalg.norm(x[i]), 1e-9) for v in model.vectors], np.float64)
        near = np.argsort(-cos)[:quality.NEIGHBOURS]
        w = np.maximum(cos[near], 1e-6) ** quality.SHARPNESS
        assert abs(got[i] - (w * model.labels[near]).sum() / w.sum()) < 1e-4


def test_batches_do_not_matter(model):
    texts = pa.array(["one two", "", "THREE!! FOUR!!", None, "x " * 3000, "la la la"])
    one = [quality.score_texts(model, texts.slice(i, 1))[0] for i in range(len(texts))]
    assert np.allclose(quality.score_texts(model, texts), one, atol=1e-5)


def test_tables(spark, model):
    df = spark.createDataFrame([(None, "the end of it", 1, "q"), (None, "the end of it", 1, "q"), (2, None, None, None)],
                               "doc_id long, text string, predicted int, label string")
    out = quality.classify(df, model)
    assert out.columns == ["doc_id", "text", "label", "score", "predicted"] and out.count() == 3
    assert quality.classify(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([(2, 1), (None, 0), (9, 1)], "doc_id long, quality int")
    assert quality.train(df, labels.limit(0)) is None
    assert {r["score"] for r in quality.classify(df, None).collect()} == {0.5}
    one = quality.train(df, labels)
    assert {r["score"] for r in quality.classify(df, one).collect()} == {1.0}
