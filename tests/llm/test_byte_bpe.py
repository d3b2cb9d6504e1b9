"""Byte-level BPE against the tiktoken library."""

import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

from docweave.llm import byte_bpe
from tests.llm.brute import read

VOCAB = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.load_ranks(VOCAB), special_tokens={})


def test_query_equals_tiktoken(spark, tik):
    d = "/root/testdata/sf0.01"
    want = {r["doc_id"]: tik.encode_ordinary(r["text"] or "") for r in read(d, "documents")}
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in read(d, "documents")}
    rows = byte_bpe.q_op6(spark, d).collect()
    assert len(rows) == len(want)
    for r in rows:
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]]).hexdigest()


ODD = [None, "", " ", "  ", "a", "aaaaaaaaaaaaaaaa" * 50, "it's we'll I'D", "  two  spaces ", "tab\t\tnew\n\n\nline ", " nbsp em\u0085nel",
       "😀👩‍👩‍👧 flags 🇩🇪", "汉字漢字 かな", "ÀÉÎ é é", "123 4567 ½ ²", "<|endoftext|>", "\x00\x01\x1f\x7f", "ß" * 300, "!?" * 200, "x" * 5000 + " y"]


def test_odd_texts(spark, tik):
    df = spark.createDataFrame([(i, t, "w") for i, t in enumerate(ODD)] + [(None, "dup", "w")] * 2, "doc_id long, text string, words_ string")
    out = byte_bpe.decode(byte_bpe.encode(df, VOCAB, public.PATTERN), VOCAB)
    assert out.columns == ["doc_id", "text", "words_", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        assert r["ids"] == tik.encode_ordinary(r["text"] or ""), r["text"]
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert byte_bpe.encode(df.limit(0), VOCAB, public.PATTERN).count() == 0
    clash = df.withColumnsRenamed({"doc_id": "text_", "words_": "__words"}).withColumn("ids", F.lit("old"))
    both = byte_bpe.round_trip(clash, VOCAB, public.PATTERN)
    assert both.columns == ["text_", "text", "__words", "ids", "decodes"]
    assert sorted((r["ids"] for r in both.collect() if r["decodes"])) == sorted(r["ids"] for r in rows)
    assert byte_bpe.encode(df, VOCAB, public.PATTERN, ids_col="text").columns == ["doc_id", "words_", "text"]


def test_decode_of_any_ids(spark, tik):
    lists = [[], None, [255, 0, 220, 1], list(range(0, 50256, 7))]
    rows = byte_bpe.decode(spark.createDataFrame([(x,) for x in lists], "ids array<int>"), VOCAB).collect()
    assert [bytes(r["decoded"]) for r in rows] == [tik.decode_bytes(x or []) for x in lists]


def test_small_slices_and_cache(tik, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 5)
    use = byte_bpe.Codec(VOCAB)
    for words in (["one", " two", "one"], [" thirteen", " fourteenth", "x", "one"], [], ["zz", "zz"]):
        ids, counts = use.encode(pa.array(words, pa.string()))
        assert [list(x) for x in np.split(ids, np.cumsum(counts))[:len(words)]] == [tik.encode_ordinary(w) for w in words]
