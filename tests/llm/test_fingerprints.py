"""Fingerprints against exact generalised Jaccard similarity."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import fingerprints, textarrays
from tests.llm.brute import read


def similar(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def words(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") for w in w.split()]


def test_collisions_equal_generalised_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for trial in range(300):
        # Weights from 1 to 40, so that levels matter.
        a = {f"w{trial}-{i}": int(rng.integers(1, 40)) for i in range(30)}
        b = {k: v if rng.random() < 0.5 else int(rng.integers(1, 40)) for k, v in a.items() if rng.random() < 0.9} | {f"v{trial}-{i}": int(rng.integers(1, 20)) for i in range(5)}
        texts = [" ".join(w for w, n in x.items() for _ in range(n)) for x in (a, b)]
        one, two = fingerprints.fingerprints(pa.array(texts))
        errors.append(fingerprints.likeness(one, two) - similar(a, b))
    errors = np.array(errors)
    # Unbiased, and spread as a mean of independent draws.
    assert abs(errors.mean()) < 4 * 0.5 / np.sqrt(fingerprints.SAMPLES * len(errors)) + 2**-16
    assert errors.std() < 1.2 * 0.5 / np.sqrt(fingerprints.SAMPLES)


@pytest.mark.parametrize("parts", [1, 7])
def test_query_equals_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(fingerprints.common, "shuffle_parts", lambda _: parts)
    d = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"] or "") for r in read(d, "documents"))
    got = {r["doc_id"]: r for r in fingerprints.q_op11(spark, d).collect()}
    assert len(got) == len(rows)
    off = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        r, gone = got[i], len(text) // 4
        new = text[:len(text) - gone] + following[:gone]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        marks = [m.hex() for m in fingerprints.fingerprints(pa.array([text, new, following]))]
        assert [r["fingerprint"], r["edited_fingerprint"]] == marks[:2]
        assert r["near_edited"] == fingerprints.likeness(*map(bytes.fromhex, marks[:2]))
        assert r["near_next"] == fingerprints.likeness(bytes.fromhex(marks[0]), bytes.fromhex(marks[2]))
        if words(text) and words(new):
            off.append(r["near_edited"] - similar(words(text), words(new)))
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.3


def test_odd_tables(spark):
    schema = "doc_id long, text string, h long, edge int, mark string"
    long = "lorem ipsum dolor " * 200_000
    rows = [(1, "a b c d e f g h", 1, 1, "m"), (1, "a b c d e f g h", 2, 2, None), (2, None, 0, 0, None), (3, "", 0, 0, None), (4, "   ", 0, 0, None), (None, "x y", 0, 0, None),
            (5, long, 0, 0, None), (6, "Über ÜBER", 0, 0, None), (7, "漢字かな交じり", 0, 0, None)]
    got = fingerprints.neighbours(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1 and by[2]["fingerprint"] == by[4]["fingerprint"] == ""
    assert by[2]["near_next"] == 1 and by[4]["near_next"] == 0 and by[2]["n_chars"] == 0 and by[5]["n_chars"] == len(long)
    assert by[7]["near_edited"] > 0.3
    assert {r["n_chars"] for r in got if r["doc_id"] is None} == {3}
    one = fingerprints.neighbours(spark.createDataFrame(rows[:1], schema)).first()
    assert one["near_next"] == 1 and one["n_chars"] == 15 and one["edited_sha256"] == hashlib.sha256(b"a b c d e f a b").hexdigest()
    assert fingerprints.neighbours(spark.createDataFrame([], schema)).count() == 0
    plain = fingerprints.fingerprint(spark.createDataFrame(rows, schema), out_col="h")
    assert sorted(plain.columns) == sorted(["doc_id", "text", "edge", "mark", "h"])
    assert [r["h"] for r in plain.where("doc_id = 7").collect()] == [by[7]["fingerprint"]]
    assert fingerprints.fingerprint(spark.createDataFrame([], schema)).count() == 0


def test_characters_of_scripts_without_spaces_are_words():
    texts = ["ab 漢字c๑ไ xé", "𠀀𠀁", "", "한국 말"]
    data, offsets = textarrays.text_bytes(pa.array(texts))
    s, e, first = textarrays.words(data, offsets, cut_scripts=True)
    found = [data[a:b].tobytes().decode() for a, b in zip(s, e, strict=True)]
    assert [found[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [["ab", "漢", "字", "c", "๑", "ไ", "xé"], ["𠀀", "𠀁"], [], ["한국", "말"]]


def test_terms_that_occur_once_and_often_follow_one_rule():
    """Samples by the plain formula for every term, and one draw for a text and its edited one."""
    rng = np.random.default_rng(3)
    count = rng.choice([1, 1, 1, 2, 7, 300], 4000)
    terms = rng.integers(1, 2**63, 900, dtype=np.uint64)[rng.integers(0, 900, 4000)]
    begin = np.append(np.arange(0, 4000, 40), 4000)
    got = fingerprints.samples(terms, count, begin)
    for k in (0, 1, 63):
        r = -np.log(np.multiply(*fingerprints._uniforms(terms, fingerprints.SEEDS[k, 0])))
        log_c = np.log(-np.log(np.multiply(*fingerprints._uniforms(terms, fingerprints.SEEDS[k, 1]))))
        beta = fingerprints._uniforms(terms, fingerprints.SEEDS[k, 2])[0]
        level = np.floor(np.log(count.astype(np.float32)) / r + beta)
        log_a = (log_c - r + r * beta) - r * level
        pick = np.array([a + np.argmin(log_a[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)])
        kept = terms[pick] + level[pick].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        assert (got[:, k] == (textarrays.mix(kept) >> np.uint64(48)).astype(np.uint16)).all()


def test_a_text_and_its_edited_one_are_drawn_for_together(monkeypatch):
    calls = []
    plain = fingerprints.samples
    monkeypatch.setattr(fingerprints, "samples", lambda *a: calls.append(len(a[0])) or plain(*a))
    texts = [f"one two three four five w{i} x{i}" for i in range(20)]
    rows = fingerprints._results(pa.array(range(20)), texts, [*texts[1:], texts[0]])
    assert len(calls) == 1  # two before
    assert rows.column("mark").to_pylist() == fingerprints.fingerprints(pa.array(texts))
    changed = [fingerprints.edited(a, b) for a, b in zip(texts, [*texts[1:], texts[0]], strict=True)]
    assert rows.column("edited_mark").to_pylist() == fingerprints.fingerprints(pa.array(changed))
