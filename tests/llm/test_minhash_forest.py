"""Near duplicates against all pairs of sets."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from docweave.llm import minhash_forest as mf
from docweave.llm.components import components as spark_components
from tests.llm.brute import components, read

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, percent=80):
    """(id, n, component, kept) of (id, text) rows."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    different = list({s for i, s in sets if i is not None and s})
    where, pairs = defaultdict(list), []
    for k, s in enumerate(different):
        near = Counter(o for x in s for o in where[x])
        pairs += [(k, o) for o, c in near.items() if 100 * c >= percent * (len(s) + len(different[o]) - c)]
        for x in s:
            where[x].append(k)
    ids = defaultdict(list)
    for i, s in sets:
        if i is not None and s:
            ids[s].append(i)
    links = [(v[0], x) for v in ids.values() for x in v] + [(ids[different[a]][0], ids[different[b]][0]) for a, b in pairs]
    comp = components({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), comp.get(i), None if i is None else comp[i] == i) for i, s in sets), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    want = brute([(r["doc_id"], r["text"]) for r in read(d, "documents")], 2)
    assert got(mf.q_op10(spark, d)) == want
    assert sum(not w[3] for w in want) > 50


def variants(words, n, changes, rng):
    out = []
    for _ in range(n):
        w = list(words)
        for at in rng.choice(len(w), changes, replace=False):
            w[at] = f"new{rng.integers(10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_groups_and_odd_rows(spark, width):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "two one", "É x y", "é x y", "a\x0bb", "a\xa0b"]
    for _ in range(12):
        words = rng.choice(vocab, 120)
        texts += variants(words, 4, 1, rng) + variants(words, 2, 4, rng) + [" ".join(words)] * 2
    texts += variants(rng.choice(vocab, 200), 150, 2, rng) + [" ".join(rng.choice(vocab, 300))] * 60
    texts += [" ".join(rng.choice(vocab, 80)) for _ in range(200)] + ["x " * 100_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (None, "unlike"), (3, "one"), (12, texts[30]), (12, texts[12])]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, n int")
    assert got(mf.near_duplicates(df, width=width)) == brute(rows, width)


def family(rng, n, planted, width, words=600, changes=23, same=8):
    """Texts of similarity 0.73 to 0.79 with each other, and pairs of them above 0.8."""
    step = 2 / width
    changes, same = round(changes * step), round(same * step)
    base = np.array([f"w{i}" for i in range(words)], object)

    def variant(at, tag):
        w = base.copy()
        w[at] = [f"{tag}x{i}" for i in at]
        return " ".join(w)

    out = [variant(rng.choice(words, changes, replace=False), f"t{k}") for k in range(n)]
    for k in range(planted):
        at = rng.choice(words, 2 * changes - same, replace=False)
        a, b = at[:changes], at[changes - same:]
        left, right = base.copy(), base.copy()
        left[a], right[b] = [f"p{k}x{i}" for i in a], [f"p{k}x{i}" if i in a else f"q{k}x{i}" for i in b]
        out += [" ".join(left), " ".join(right)]
    return [out[i] for i in rng.permutation(len(out))]


@pytest.mark.parametrize(("width", "block"), [(2, 1000), (2, 60)])
def test_pairs_in_a_crowded_region(spark, monkeypatch, width, block):
    monkeypatch.setattr(mf, "BLOCK", block)
    rows = list(enumerate(family(np.random.default_rng(11), 300, 60, width)))
    want = brute(rows, width)
    assert 50 < sum(not w[3] for w in want) < 100
    assert got(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width)) == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert mf.near_duplicates(df).count() == 0


def test_signature_agreement_is_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = mf.signatures([np.unique(base[:900]), np.unique(base[100:])])
    assert abs((a == b).mean() - 0.8) < 0.1


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(1000, 1400)] + [(5, int(x)) for x in rng.integers(6, 900, 300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got_ = {r["id"]: r["component"] for r in spark_components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    want = components({x for p in pairs for x in p}, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got_ == {i: want[i] for i in nodes}
    assert spark_components(spark.createDataFrame([], "x long, y long")).count() == 0
