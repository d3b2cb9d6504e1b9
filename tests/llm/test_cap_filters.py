"""Near embeddings against all pairs."""

import math

import numpy as np

from docweave.llm import cap_filters as cf
from tests.llm.brute import components, read


def brute(rows, least=0.95):
    good = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, pairs = [0] * len(rows), []
    for d in {len(rows[k][1]) for k in good}:
        own = [k for k in good if len(rows[k][1]) == d]
        m = np.array([rows[k][1] for k in own], np.float64)
        norm = np.sqrt((m * m).sum(1))
        a, b = np.nonzero((m @ m.T) / np.outer(norm, norm) >= least)
        for i, j in zip(a, b, strict=True):
            if i != j:
                links[own[i]] += 1
                pairs.append((own[i], own[j]))
    comp = components({i for i, _ in rows if i is not None}, [(rows[a][0], rows[b][0]) for a, b in pairs if rows[a][0] is not None and rows[b][0] is not None])
    return sorted(((i, links[k], comp.get(i), None if i is None else comp[i] == i) for k, (i, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in read(d, "embeddings")]
    assert got(cf.q_op7(spark, d)) == brute(rows)
    # The table has few links or none: add noisy copies of every other vector.
    rng = np.random.default_rng(4)
    for i, v in list(rows[::2]):
        v = np.array(v)
        noise = rng.standard_normal(len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * rng.uniform(0.05, 0.36)
        rows.append((i + 10**6, [float(x) for x in (v + noise).astype(np.float32)]))
    want = brute(rows)
    assert sum(w[1] for w in want) > 1500
    assert got(cf.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))) == want


def test_groups_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(cf, "BLOCK", 16)
    rng = np.random.default_rng(2)
    around = lambda v, n, s: [list((v + rng.standard_normal(24) * s).astype(np.float32)) for _ in range(n)]
    vecs = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [-1.0, -2.0]]
    vecs += around(rng.standard_normal(24) * 3, 150, 0.1) + [list(rng.standard_normal(24).astype(np.float32))] * 70
    for _ in range(15):
        vecs += around(rng.standard_normal(24) * 3, 4, 0.5)
    vecs += [list(rng.standard_normal(24).astype(np.float32)) for _ in range(100)]
    vecs = [v if v is None else [x if x is None else float(x) for x in v] for v in vecs]
    rows = list(enumerate(vecs)) + [(None, vecs[20])]
    df = spark.createDataFrame([(*r, "l", 3) for r in rows], "vec_id long, embedding array<float>, key string, n int")
    want = brute(rows)
    assert got(cf.near_embeddings(df)) == want


def test_empty(spark):
    assert cf.near_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_list_decoding_is_complete_and_recall_is_high():
    rng = np.random.default_rng(9)
    codes = [cf.make_code(64, 100_000, i) for i in range(cf.CODES)]
    code = codes[0]
    size = len(code.words[0])
    sure = 0
    for _ in range(200):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        r = x @ code.rotation
        sums = np.add.outer(code.words[0] @ r[:32], code.words[1] @ r[32:]).ravel()
        found = cf.list_decode(code, x)
        want = np.flatnonzero(sums >= code.threshold)
        assert set(want) <= set(found) and len(found) >= cf.MIN_LISTS
        assert len(want) < cf.MIN_LISTS or list(found) == list(want)
        y = rng.standard_normal(64)
        y -= (y @ x) * x
        y = 0.95 * x + math.sqrt(1 - 0.95**2) * y / np.linalg.norm(y)
        sure += bool(set(cf.all_filters(codes, x)) & set(cf.all_filters(codes, y)))
    assert size * size > 4_000 and sure >= 199
