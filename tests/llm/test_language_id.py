"""Language identification: held-out accuracy, rejection, odd rows."""

import numpy as np
import pytest

from docweave.llm import common
from docweave.llm import language_id as lid

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return lid.train(common.table(spark, D, "documents"), ~common.held_out("doc_id"))


def test_held_out_accuracy(spark):
    docs = common.table(spark, D, "documents").select("doc_id", "lang")
    rows = lid.q_op2(spark, D).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert 100 < len(held) < 300
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    # Clean documents stay.
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)


def test_odd_texts(model):
    langs, scores, rejected = lid.score_texts(model, [None, "", "12345 $$", "Привет мир как дела друзья", "that is the one of them", "の" * 50])
    assert langs[:3] == ["und"] * 3 and list(scores[:3]) == [0, 0, 0]
    assert list(rejected) == [True, True, True, True, False, True]


def test_batches_do_not_matter(model):
    texts = ["the and of that", "", "der und die das ist", "x", "que el de la", "le la les et des"] * 3
    one = [lid.score_texts(model, [t]) for t in texts]
    langs, scores, rejected = lid.score_texts(model, texts)
    assert langs == [o[0][0] for o in one] and list(rejected) == [o[2][0] for o in one]
    assert np.allclose(scores, [o[1][0] for o in one])


def test_long_text(model):
    assert lid.score_texts(model, ["der und die das ist " * 100_000])[0] == ["de"]


def test_tables(spark, model):
    df = spark.createDataFrame([(None, "the end of it", 1.5, "q"), (None, "the end of it", 1.5, "q"), (2, None, None, None)],
                               "doc_id long, text string, score double, batch string")
    out = lid.identify(df, model)
    assert out.columns == ["doc_id", "text", "batch", "lang_pred", "score", "rejected"] and out.count() == 3
    assert lid.identify(df.limit(0), model).count() == 0
    none = lid.train(df.withColumn("lang", df.batch).where("lang IS NULL"))
    assert none is None and {r["lang_pred"] for r in lid.identify(df, none).collect()} == {"und"}
