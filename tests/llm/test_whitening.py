"""Whitening against numpy on the whole fit list."""

import math

import numpy as np
import pytest

from docweave.llm import whitening
from tests.llm.brute import read


def brute(rows, most=8):
    """``vec_id -> (deviation, |whitened| list)`` and the shares of the variance."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True)) for v in x]
    centred = np.array(x, float) - np.array(total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = centred @ vectors[:, :most] / np.sqrt(values[:most])
    return [i for i, _ in kept], n, deviation, z, values[:most] / values.sum()


def check(got, rows, most=8):
    ids, n, deviation, z, shares = brute(rows, most)
    assert len(got) == len(ids) * z.shape[1] and {r["n"] for r in got} == {n}
    table = {(r["vec_id"], r["component"]): r for r in got}
    signs = None
    for i, d, point in zip(ids, deviation, z, strict=True):
        mine = np.array([table[i, k + 1]["whitened"] for k in range(z.shape[1])])
        signs = np.sign(mine * point) if signs is None else signs
        assert np.abs(mine - signs * point).max() < 1e-8
        assert {table[i, k + 1]["deviation"] for k in range(z.shape[1])} == {d}
    assert all(abs(table[ids[0], k + 1]["explained"] / s - 1) < 1e-9 for k, s in enumerate(shares))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_numpy(spark, sf):
    d = f"/root/testdata/{sf}"
    check(whitening.q_op12(spark, d).collect(), [(r["vec_id"], r["embedding"]) for r in read(d, "embeddings")])


def test_shared_vectors_and_bad_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    some = [[float(c) for c in v] for v in rng.normal(size=(40, 10))]
    rows = [(i, some[0] if i % 3 == 0 else some[int(rng.integers(40))]) for i in range(600)]
    bad = [(1000, None), (1001, [None, *some[0][1:]]), (1002, [math.nan, *some[0][1:]]), (1003, [math.inf, *some[0][1:]]), (1004, [])]
    df = spark.createDataFrame([(i, v, "c", 1, 2.0) for i, v in rows + bad], "vec_id long, embedding array<double>, x string, weight int, z double")
    for heavy in (3, 1000):
        monkeypatch.setattr(whitening, "HEAVY", heavy)
        check(whitening.whiten(df).collect(), rows)


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, n string"
    make = lambda rows: spark.createDataFrame(rows, schema)
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None, "a"), (2, [], "a")])).count() == 0
    # Without variance there is no component.
    assert whitening.whiten(make([(1, [1.0, 2.0], "a")] * 3)).count() == 0
    got = whitening.whiten(make([(1, [1.0, 2.0], "a"), (1, [3.0, 2.0], "a"), (None, [5.0, 2.0], None), (9, [1.0], None)])).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got if r["vec_id"]) == [(1, 1), (1, 1)] and len(got) == 3
    assert sorted(round(abs(r["whitened"]), 6) for r in got) == [0.0, 1.224745, 1.224745] and {r["explained"] for r in got} == {1.0}
    assert {r["deviation"] for r in got} == {0, (3 * 2048) ** 2}


def test_exact_beyond_64_bits(spark):
    rows = [(i, [float(2**43 * (i % 2)), float(i % 3)]) for i in range(6)]
    distinct = whitening.distinct_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(whitening.grid(whitening.F.col("embedding")).alias("x")))
    n, total = whitening.sums(distinct, 2)
    assert n == 6 and list(total) == [3 * 2**53 + 600_000, 6 * 1024 + 600_000]
