"""Decontamination against every alignment of every item."""

import itertools
import re

import pytest

from docweave.llm import common
from docweave.llm import decontaminate as dec
from tests.llm.brute import read


#: Scripts without spaces: each character is a token.
SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"


def toks(text):
    return re.findall(f"[{SINGLE}]|(?:(?![{SINGLE}])[a-z0-9\x80-\U0010ffff])+", (text or "").lower())


def brute(text, items):
    """Ids of the items that some alignment agrees with."""
    doc, found = toks(text), set()
    words = {w: [i for i, x in enumerate(doc) if x == w] for w in set(doc)}
    for item, t in items.items():
        t = toks(t)
        need = min(len(t), dec.MIN_OVERLAP)
        if len(t) < dec.SHORTEST_ITEM:
            if t and any(doc[i:i + len(t)] == t for i in words.get(t[0], ())):
                found.add(item)
            continue
        for shift in {p - j for j, w in enumerate(t) for p in words.get(w, ())}:
            agree = [0 <= j + shift < len(doc) and doc[j + shift] == w for j, w in enumerate(t)]
            if any(sum(agree[i:i + need]) >= dec.MIN_SHARE * need for i in range(len(agree) - need + 1)):
                found.add(item)
    return found


@pytest.mark.parametrize("n", range(dec.SHORTEST_ITEM, dec.MIN_OVERLAP + 1))
def test_masks_hit_every_stretch(n):
    for wrong in itertools.combinations(range(n), n - dec._needed(n)):
        assert any(not any(o + k in wrong for k in m) for m in dec.MASKS for o in range(n - m[-1])), wrong


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    items = {r["item_id"]: r["text"] for r in read(d, "benchmark")}
    docs = {r["doc_id"]: r["text"] for r in read(d, "documents")}
    rows = dec.q_op8(spark, d).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: {int(x) for x in r["items"].split(",") if x} for r in rows}
    want = {k: brute(t, items) for k, t in docs.items()}
    assert got == want and sum(map(bool, want.values())) > 10
    assert all(r["contaminated"] == bool(r["items"]) for r in rows)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(f"alpha{i}" for i in range(30))), (2, " ".join(f"beta{i}" for i in range(9))), (3, "too short to prove"), (4, None), (5, ""),
            (None, " ".join(f"gamma{i}" for i in range(14))), (7, " ".join(f"alpha{i}" for i in range(30)))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_substitutions_and_odd_rows(spark, items):
    alpha = [f"alpha{i}" for i in range(30)]
    swap = lambda at, w: " ".join("zzz" if i in at else x for i, x in enumerate(w))
    texts = [
        (1, "x " * 50 + " ".join(alpha) + " y" * 9, {1}), (2, "x " + " ".join(alpha[:13]), {1}), (3, " ".join(alpha[:10]), set()),
        (4, swap({2, 7}, alpha[5:18]) + " end", {1}), (5, swap({0, 3, 6, 9, 12}, alpha[5:18]), set()),
        (6, "***".join(alpha).upper(), {1}), (7, " ".join(f"beta{i}" for i in range(9)), {2}), (8, swap({4}, [f"beta{i}" for i in range(9)]), {2}),
        (9, "too short to prove", set()), (10, None, set()), (11, "", set()), (12, "a b c", set()),
        (None, " ".join(f"gamma{i}" for i in range(14)), {-1}), (14, " ".join(alpha) + " q " + " ".join(f"beta{i}" for i in range(9)), {1, 2}),
        (15, "w " * 400_000 + " ".join(alpha), {1}),
    ]
    df = spark.createDataFrame([(i, t, "k", 0) for i, t, _ in texts] * 2, "doc_id long, text string, row string, stretches int")
    out = dec.find_leaks(df, items)
    assert out.columns == ["doc_id", "text", "row", "stretches", "contaminated", "bench_items"]
    got = [(r["doc_id"], set(r["bench_items"])) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(i, w) for i, _, w in texts] * 2, key=repr)


def test_empty_tables(spark, items):
    df = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")
    assert dec.find_leaks(df.limit(0), items).count() == 0
    assert [r["contaminated"] for r in dec.find_leaks(df, items.limit(0)).collect()] == [False]


def test_scan_keeps_few_rows(spark):
    d = "/root/testdata/sf0.01"
    _, seeds = dec.benchmark_seeds(common.table(spark, d, "benchmark"), "item_id", "text")
    docs = common.table(spark, d, "documents").select("doc_id", "text")
    scanned = dec.scan(docs, "text", dec.seed_bitmap(seeds), ["doc_id"])
    assert scanned.where("row IS NOT NULL").count() < 0.4 * docs.count()


def test_short_items_count_whole(spark):
    bench = spark.createDataFrame([(1, "What is Rust?"), (2, "why"), (3, " ".join("abcdefg")), (4, " ".join(f"beta{i}" for i in range(9))), (5, "")], "item_id long, text string")
    texts = ["x what IS rust y", "what is", "what is old rust", "why", "whyever", "z a b c d e f g", "a b c d e f", "what is rust? why", None, "",
             "q " + " ".join("zzz" if i == 4 else f"beta{i}" for i in range(9))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["bench_items"] for r in dec.find_leaks(df, bench, short=True).collect()}
    assert got == dict(enumerate([[1], [], [], [2], [], [3], [], [1, 2], [], [], [4]]))


def test_passages_in_scripts_without_spaces_and_ten_token_items(spark):
    rows = [(1, "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"), (2, "ประเทศไทยรวมเลือดเนื้อ"), (3, " ".join(f"w{i}" for i in range(10))), (4, "道可道")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    ten = " ".join("zz" if i in (4, 6) else f"w{i}" for i in range(10))
    texts = ["他说春眠不觉晓处处闻啼鸟夜来风雨声花落知多少好诗", "春眠不觉晓处处", "春眠不觉晓人人闻啼鸟夜来风雨声", "กรุงเทพประเทศไทยรวมเลือดเนื้อชาติ", ten, "q " + ten + " q", "非道可道也", "道可非道", "春 眠"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: set(r["bench_items"]) for r in dec.find_leaks(df, bench, short=True).collect()}
    assert got == {i: brute(t, dict(rows)) for i, t in enumerate(texts)} == dict(enumerate([{1}, set(), {1}, {2}, {3}, {3}, {4}, set(), set()]))
