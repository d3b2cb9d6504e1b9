"""Token files: round trips, the library's ids, damage."""

import io
import struct
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docweave.llm import common, range_coder, token_files
from tests.llm.brute import read

PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def brute(rows, tok):
    out, start = [], 0
    for doc, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_query_equals_library(spark, tok):
    d = "/root/testdata/sf0.01"
    want = brute(sorted((r["doc_id"], r["text"]) for r in read(d, "documents")), tok)
    assert sorted(tuple(r) for r in token_files.q_op1(spark, d).collect()) == want


def test_odd_texts(spark, tok):
    texts = [None, "", " \t\n\x0b", "a", "É́ é Σας ΣΑΣ", "it's WE'LL", "a b c ́d", "<|endoftext|> <|startoftext|>x", "😀👩‍👩‍👧", "x" * 3000, "é " * 40_000, "\x00 \x85"]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, id string, row int")
    manifest = token_files.write_token_files(df, common.shared_folder(spark, "t"), PATH)
    rows = sorted(token_files.read_token_files(manifest, with_ids=True).collect())
    assert [tuple(r)[:4] for r in rows] == brute(list(enumerate(texts)), tok)
    assert all(crc(r["ids"]) == r["ids_crc32"] for r in rows)
    empty = token_files.write_token_files(df.limit(0), common.shared_folder(spark, "t"), PATH)
    assert token_files.read_token_files(empty).count() == 0


def test_rows_without_or_with_equal_ids(spark):
    df = spark.createDataFrame([(None, "b"), (None, "b"), (3, "a b"), (3, "c"), (-1, None)], "doc_id long, text string")
    rows = token_files.read_token_files(token_files.write_token_files(df, common.shared_folder(spark, "t"), PATH)).collect()
    rows = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, -1, 3, 3]
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1])


def test_words_cut_at_marks_and_learnt_at_once(tok):
    """Words of letters reach the library many to a text, without the mark after them."""
    texts = ["Éa, éa. éa! a.b,c x.'s it's. WE'LL, É, e\u0301, H\u0331. ×, ÷. ÿ;ÿ", None, "a", ",a", ".", "<|endoftext|>, endoftext.<|startoftext|> a<|endoftext|>b.",
             "ab12.5,c 3. ǅ, ﬁ. ſ! ß? Σας, ΣΑΣ.", "a,\u0338b.\u0301c a.", ", ,a ., .a"] + [f"wörd{'xyz'[i % 3] * (i % 7)}ñ{chr(97 + i % 26)}, " * 2 for i in range(3000)]
    words, calls = token_files.Words(PATH), [0]
    library = words._library
    words._library = lambda w: calls.__setitem__(0, calls[0] + len(w)) or library(w)
    for some in (texts, texts[::-1]):
        ids, counts = words.encode(pa.array(some, pa.string()))
        want = [tok.encode(t or "", add_special_tokens=False).ids for t in some]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert 0 < calls[0] < 60 and sum(w.as_py().endswith(",") for w in words.known) < 10


def test_an_id_takes_one_step_of_the_coder(monkeypatch):
    ids, steps = (np.random.default_rng(3).zipf(1.2, 5000) % 900).astype(np.uint32), [0]
    for side in (range_coder.Encoder, range_coder.Decoder):
        code = side.code
        monkeypatch.setattr(side, "code", lambda self, *a, code=code: steps.__setitem__(0, steps[0] + 1) or code(self, *a))
    coded = range_coder.encode([ids])
    assert (range_coder.decode(coded, [len(ids)])[0] == ids).all() and steps[0] == 2 * len(ids)


def test_carries_and_ends_of_the_coder():
    """Many lanes of many lengths, so that words carry over and lanes end alike and apart."""
    rng = np.random.default_rng(8)
    blocks = [(rng.zipf(1.1 + rng.random(), n) % rng.integers(1, 2**20)).astype(np.uint32) for n in rng.integers(0, 700, 3000)]
    coded = range_coder.encode(blocks)
    back = range_coder.decode(coded, [len(b) for b in blocks])
    assert all(len(a) == len(b) and (a == b).all() for a, b in zip(blocks, back, strict=True))


@pytest.mark.parametrize("bits", [1, 4, 9, 16, 24])
def test_coder_round_trip(bits):
    rng = np.random.default_rng(bits)
    top = 2**bits
    blocks = [np.zeros(0, np.uint32), rng.integers(0, top, 900, dtype=np.uint32), np.full(3000, top - 1, np.uint32), np.arange(50, dtype=np.uint32) % top,
              (rng.zipf(1.3, 2500) % top).astype(np.uint32), np.tile(rng.integers(0, top, 7, dtype=np.uint32), 300)]
    coded = range_coder.encode(blocks)
    back = range_coder.decode(coded, [len(b) for b in blocks])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back, strict=True))
    assert len(coded[2]) < 300 and len(coded[5]) < 400
    # Any block decodes by its bytes alone, and is coded alike whatever lies beside it.
    for i, block in enumerate(blocks):
        assert (range_coder.decode([coded[i]], [len(block)])[0] == block).all()
        assert range_coder.encode([block]) == [coded[i]]
    assert range_coder.decode(range_coder.encode([]), []) == []


def test_order_0_adapts():
    """No id repeats what one or two ids before foretell; few different ids cost less."""
    rng = np.random.default_rng(5)
    few, many = (rng.permutation(np.repeat(rng.integers(0, 2**16, n, dtype=np.uint32), 1024 // n)) for n in (16, 512))
    coded = range_coder.encode([few, many])
    assert len(coded[0]) < 0.45 * len(coded[1])


def test_natural_ids_shrink(tok):
    ids = np.array([i for r in read("/root/testdata/sf0.001", "documents") for i in tok.encode(r["text"], add_special_tokens=False).ids], np.uint32)
    coded = range_coder.encode([ids[a:a + 4096] for a in range(0, len(ids), 4096)])
    print(sum(map(len, coded)) / (2 * len(ids)))
    assert sum(map(len, coded)) < 0.55 * 2 * len(ids)


class _Out(io.BytesIO):
    def close(self):
        pass


def test_damage_is_found():
    out = _Out()
    writer = token_files.Writer(out)
    lengths = np.array([9000, 1, 500])
    writer.add([5, None, 7], np.arange(lengths.sum(), dtype=np.uint32) % 500, lengths)
    writer.close()
    data = out.getvalue()
    docs = list(token_files.read_file(io.BytesIO(data), len(data)))
    assert [d for d, _, done in docs if done] == [5, None, 7] and sum(len(p) for _, p, _ in docs) == lengths.sum()
    want, found = [(d, p.tolist()) for d, p, _ in docs], 0
    places = range(0, len(data), 89)
    for at in places:
        bad = bytearray(data)
        bad[at] ^= 0x55
        try:
            # A change in the last bytes of a block's coder may not matter.
            assert [(d, p.tolist()) for d, p, _ in token_files.read_file(io.BytesIO(bytes(bad)), len(bad))] == want
        except (ValueError, IndexError, struct.error, zlib.error):
            found += 1
    assert len(places) > 30 and found > 0.8 * len(places)
