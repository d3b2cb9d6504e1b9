"""Tokenizer alignment against the libraries and a walk over both id lists."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docweave.llm import alignment
from tests.llm.brute import read

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return a, b, alignment.byte_tokens(a), alignment.piece_tokens(b)


def walk(text, libraries):
    """``(ids of A, ids of B, groups, links)``, or None without tokens."""
    a, b, bytes_a, bytes_b = libraries
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if any(b"".join(t[i] for i in x) != whole for t, x in zip((bytes_a, bytes_b), ids, strict=True)):
        return None
    spans = []
    for t, x in zip((bytes_a, bytes_b), ids, strict=True):
        ends = np.cumsum([len(t[i]) for i in x]).tolist()
        spans.append(list(zip([0, *ends[:-1]], ends, x, strict=True)))
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, before = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for s, e, i in side if before <= s and e <= cut) for side in spans) if len(whole) < 3000 else None)
        before = cut
    links, j = [], 0
    for s, e, i in spans[0]:
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, spans[1][k][2]))
            k += 1
    return *ids, groups, links


def check(got, texts, libraries):
    found = [walk(t, libraries) for t in texts]
    count = Counter(x for f in found if f for x in f[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    want = Counter()
    for t, f in zip(texts, found, strict=True):
        if f is None:
            want[t, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            spelled = ";".join(f[2]) if None not in f[2] else None
            want[t, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]),
                 hashlib.sha256(spelled.encode()).hexdigest() if spelled else "long"] += 1
    mine = Counter()
    for t, r in zip(texts, got, strict=True):
        digest = "long" if r["groups_sha256"] and len((" " + t).encode()) >= 3000 else r["groups_sha256"]
        mine[t, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], digest] += 1
    assert mine == want


@pytest.mark.parametrize("common", [alignment.COMMON, 50, 1])
def test_query_equals_walk(spark, libraries, common, monkeypatch):
    monkeypatch.setattr(alignment, "COMMON", common)
    d = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in alignment.q_op13(spark, d).collect()}
    rows = {r["doc_id"]: r["text"] for r in read(d, "documents")}
    assert got.keys() == rows.keys()
    check([got[i] for i in rows], list(rows.values()), libraries)


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  ", "two  spaces   three ", "tab\tnew\n\n line\r\n  x \n", "nbsp  x   y　 z", "bl▁ock", "▁", "x▁ y",
       "<|endoftext|> </s> <unk> <0x41>", "😀👩‍👩‍👧 🇩🇪", "汉字 漢字 かな", "ÀÉ é  é", "\x00\x01 \x7f  b", "ﬁ ① ｆｕｌｌ", "x" * 20_000 + " y", "!? " * 300, "it's we'll I'D  don't"]


def test_odd_texts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "LEARN_WORDS", 3)
    monkeypatch.setattr(alignment, "CACHE_WORDS", 10)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 40)
    texts = ODD * 2
    df = spark.createDataFrame([(i if i % 5 else None, t, 1, 2, "c") for i, t in enumerate(texts)], "doc_id long, text string, a int, row long, times string")
    # One number per row tells them apart.
    keyed = alignment.align(df.withColumn("n", alignment.F.monotonically_increasing_id()), A, B, id_col="n").orderBy("n").collect()
    order = [r["text"] for r in df.withColumn("n", alignment.F.monotonically_increasing_id()).orderBy("n").collect()]
    check(keyed, order, libraries)
    assert alignment.align(df, A, B).where("doc_id IS NULL").count() == sum(i % 5 == 0 for i in range(len(texts)))
    assert alignment.align(df.limit(0), A, B).count() == 0


def test_words_are_encoded_as_in_their_texts(libraries):
    """Random texts of awkward characters: a word's ids don't depend on its neighbours."""
    rng = np.random.default_rng(5)
    letters = np.array(list("ab  \t\n.'1é漢  　'ſ▁😀"))
    texts = ["".join(rng.choice(letters, int(rng.integers(1, 40)))) for _ in range(3000)]
    pair = alignment.Pair(A, B)
    spaced = pa.array([" " + t for t in texts], pa.large_string())
    data, offsets = alignment.textarrays.text_bytes(spaced)
    (ids_a, n_a), (ids_b, n_b) = pair.encode(data, offsets)
    a, b, _, bytes_b = libraries
    for i, (t, x, y) in enumerate(zip(texts, np.split(ids_a, np.cumsum(n_a)[:-1]), np.split(ids_b, np.cumsum(n_b)[:-1]), strict=True)):
        assert x.tolist() == a.encode(" " + t, add_special_tokens=False).ids, (i, t)
        assert "▁" in t or y.tolist() == b.encode(t), (i, t)


def test_coalesce_and_overlaps():
    start, end, side = np.array([0, 5, 9, 0, 2, 5, 7]), np.array([5, 9, 12, 2, 5, 7, 12]), np.array([0, 0, 0, 1, 1, 1, 1])
    order, group = alignment.coalesce(start, end, side)
    assert start[order].tolist() == [0, 0, 2, 5, 5, 7, 9] and group.tolist() == [0, 0, 0, 1, 1, 1, 1]
    i, j = alignment.overlaps(start[:3], end[:3], start[3:], end[3:])
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 3)]
