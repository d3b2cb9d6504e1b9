import random

import pytest
from conftest import page_df
from pyspark.sql import functions as F

from docweave.operators import hierarchy as H
from docweave.session import materialize


def cell(name, inner=""):
    return f'<tr><td class="hierarchy-label-cell"><a href="{name}">{name}</a>{inner}</td></tr>'


def nested(*rows):
    return '<table class="hierarchy-table-collapsed">' + "".join(rows) + "</table>"


PAGE = ('<table class="hierarchy-table" id="hrch">'
        + cell("A", nested(cell("B", nested(cell("C"))), cell("D")))
        + '<tr><td class="hierarchy-label-cell">no link' + nested(cell("Hidden")) + "</td></tr>"
        + cell("E") + "</table>")


def test_edges_direct_parent_and_depth(spark):
    e = H.hierarchy_edges(page_df(spark, PAGE), max_depth=10)
    got = sorted(((r.name, r.parent, r.depth) for r in e.collect()), key=repr)
    # a label cell without its own link is named by the first link inside it
    # (descendant semantics), here its child's
    assert got == sorted([("A", None, 0), ("B", "A", 1), ("C", "B", 2), ("D", "A", 1), ("E", None, 0),
                          ("Hidden", None, 0), ("Hidden", "Hidden", 1)], key=repr)


def test_max_depth_cuts_subtrees(spark):
    e = H.hierarchy_edges(page_df(spark, PAGE), max_depth=1)
    assert sorted(r.name for r in e.collect()) == ["A", "B", "D", "E", "Hidden", "Hidden"]
    e0 = H.hierarchy_edges(page_df(spark, PAGE), max_depth=0)
    assert sorted(r.name for r in e0.collect()) == ["A", "E", "Hidden"]


def test_walk_preorder_cycle_guard_and_two_parents(spark):
    flat = spark.createDataFrame(
        [("R", None), ("X", "R"), ("Y", "R"), ("Z", "X"), ("Z", "Y"), ("R2", None), ("Q", "W"), ("W", "Q")],
        "name string, parent string")
    w = H.hierarchy_walk(spark, flat).orderBy("path").collect()
    assert [tuple(r.path) for r in w] == [("R",), ("R", "X"), ("R", "X", "Z"), ("R", "Y"), ("R", "Y", "Z"), ("R2",)]
    c = H.hierarchy_closure(spark, flat).collect()
    assert ("Q", "Q") not in {(r.anc, r.name) for r in c if r.depth > 2}
    assert sorted(r.name for r in H.hierarchy_roots(flat).collect()) == ["R", "R2"]


def test_organize_segments(spark):
    flat = spark.createDataFrame([("A", None), ("B", "A")], "name string, parent string")
    ents = spark.createDataFrame([
        ("A", "class", [], "a", 0), ("B", "class", ["A"], "b", 1), ("Lone", "class", [], "l", 2),
        ("f", "function", ["A", "B", "A"], "f", 3), ("g", "enum", ["zzz"], "g", 4), ("", "class", [], "e", 5),
    ], "name string, entity_type string, navigation array<string>, source_path string, line long")
    o = H.organize_by_hierarchy(spark, ents, flat).orderBy("segment", "path", "kind", "ord").collect()
    got = [(r.segment, "/".join(r.path), r.kind, r.name) for r in o]
    assert got == [(1, "A", 0, "A"), (1, "A", 1, "f"), (1, "A", 1, "f"), (1, "A/B", 0, "B"), (1, "A/B", 1, "f"),
                   (2, "", 0, "Lone"), (3, "", 1, "g")]


def test_walk_not_capped_by_recursion_row_limit(spark):
    chain = spark.range(0, 60).selectExpr("CAST(id AS STRING) AS name",
                                          "CASE WHEN id > 0 THEN CAST(id - 1 AS STRING) END AS parent")
    old = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "10")
    try:
        assert H.hierarchy_walk(spark, chain).count() == 60
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", old)
    assert H.hierarchy_walk(spark, chain, max_depth=9).count() == 10


def deep(n):
    return '<table class="hierarchy-table" id="hrch">' + "".join(
        f'<tr><td class="hierarchy-label-cell"><a href="D{i}">D{i}</a><table>' for i in range(n)) + "</table></td></tr>" * n + "</table>"


def test_no_depth_is_lost(spark):
    """120 levels: every cell, the walk past the session's own recursion cap."""
    flat = H.hierarchy_flat(H.hierarchy_edges(page_df(spark, deep(120)), max_depth=None))
    assert sorted((r.depth, r.name, r.parent) for r in flat.collect())[1:] == [(i, f"D{i}", f"D{i - 1}") for i in range(1, 120)]
    before = spark.conf.get("spark.sql.cteRecursionLevelLimit")
    assert H.hierarchy_walk(spark, flat).agg(F.max("depth")).first()[0] == 119
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == before


def test_document_order(spark):
    page = '<table class="hierarchy-table" id="hrch">' + cell("Root", nested(cell("Zeta"), cell("Alpha"))) + cell("Aroot") + "</table>"
    flat = H.hierarchy_flat(H.hierarchy_edges(page_df(spark, page)))
    assert [r.name for r in H.hierarchy_walk(spark, flat).orderBy("places").collect()] == ["Root", "Zeta", "Alpha", "Aroot"]
    kids = H.hierarchy_children(flat).first()
    assert (kids.first_child, kids.last_child, kids.n_children) == ("Zeta", "Alpha", 2)


def test_closure_has_each_pair_once(spark):
    """A ladder of diamonds: the paths double at each step, the pairs do not."""
    rows = [("n0", None)]
    for i in range(12):
        rows += [(f"a{i}", f"n{i}"), (f"b{i}", f"n{i}"), (f"n{i + 1}", f"a{i}"), (f"n{i + 1}", f"b{i}")]
    flat = spark.createDataFrame(rows, "name string, parent string")
    got = [(r.anc, r.name, r.depth) for r in H.hierarchy_closure(spark, flat).collect()]
    assert len(got) == len({g[:2] for g in got})
    assert dict.fromkeys([("n0", "n12", 24)]).keys() <= set(got)


def test_related_entities_of_deep_and_rootless_classes_are_written(spark):
    rows = [("D0", None)] + [(f"D{i}", f"D{i - 1}") for i in range(1, 14)] + [("Q", "W"), ("W", "Q")]
    flat = spark.createDataFrame(rows, "name string, parent string")
    ents = spark.createDataFrame([("f", "function", ["D12"], "f", 0, "kept"), ("Q", "class", [], "q", 1, "kept"), ("g", "enum", ["Q"], "g", 2, "kept")],
                                 "name string, entity_type string, navigation array<string>, source_path string, line long, module string")
    got = [(r.segment, r.path[-1] if r.path else None, r.name, r.module) for r in H.organize_by_hierarchy(spark, ents, flat).orderBy("segment").collect()]
    assert got == [(1, "D12", "f", "kept"), (2, None, "Q", "kept"), (3, None, "g", "kept")]


def test_edges_cost_grows_with_the_page(spark):
    """Cells are rows and a parent is a join: no lookup scans the page again."""
    plan = H.hierarchy_edges(page_df(spark, PAGE))._jdf.queryExecution().executedPlan().toString()
    assert "element_at" not in plan and "map_from_arrays" not in plan
    kids = "".join(cell(f"C{i}", nested(*[cell(f"G{i}_{j}") for j in range(60)])) for i in range(50))
    page = '<table class="hierarchy-table" id="hrch">' + cell("Root", nested(kids)) + "</table>"
    e = H.hierarchy_edges(page_df(spark, page), max_depth=10).collect()
    assert len(e) == 1 + 50 + 50 * 60
    by = {r.name: (r.parent, r.depth) for r in e}
    assert by["Root"] == (None, 0) and by["C7"] == ("Root", 1) and by["G7_59"] == ("C7", 2)


def brute_walk(rows, max_depth=None):
    """Recursive pre-order walk; siblings by name."""
    kids = {}
    for name, parent in rows:
        if parent is not None:
            kids.setdefault(parent, set()).add(name)
    children = {n for n, p in rows if p is not None}
    out = []

    def go(path):
        out.append(tuple(path))
        if max_depth is None or len(path) <= max_depth:
            for k in sorted(kids.get(path[-1], ())):
                if k not in path:
                    go([*path, k])

    for root in sorted({n for n, _ in rows} - children):
        go([root])
    return out


@pytest.mark.parametrize(("seed", "depth"), [(1, None), (2, 4)])
def test_walk_of_random_graphs(spark, seed, depth):
    """Several roots, two-parent nodes, rings reached and not reached, self-loops, repeated rows."""
    rng = random.Random(seed)
    rows = [(f"t{i}", f"t{rng.randrange(i)}" if i > 2 else None) for i in range(60)] + [(f"x{i}", f"t{rng.randrange(60)}") for i in range(4)]
    rows += [("x0", "t3"), ("x1", "x0"), ("x2", "x1"), ("x0", "x2"), ("y", "x1"), ("self", "self"), ("r1", "r2"), ("r2", "r1"), ("below", "r1"), rows[5]]
    flat = spark.createDataFrame(rows, "name string, parent string")
    got = H.hierarchy_walk(spark, flat, depth).orderBy("places").collect()
    assert [tuple(r.path) for r in got] == brute_walk(rows, depth)
    assert all(r.root == r.path[0] and r.name == r.path[-1] and r.depth == len(r.path) - 1 for r in got)
    dist = {}
    kids = {(p, n) for n, p in rows if p and p != n}
    for a in {n for pair in kids for n in pair}:
        level, seen, d = {a}, {a}, 0
        while level:
            d, level = d + 1, {n for p, n in kids if p in level} - seen
            seen |= level
            dist |= {(a, n): d for n in level}
    assert {(r.anc, r.name): r.depth for r in H.hierarchy_closure(spark, flat).collect()} == dist


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    """1,000 levels: ten rounds of doubling, two passes; a row carries numbers only."""
    from docweave.operators import forest

    calls = []
    monkeypatch.setattr(forest, "materialize", lambda df: calls.append(1) or materialize(df))
    chain = spark.range(0, 1000).selectExpr("CAST(id AS STRING) AS name", "CASE WHEN id > 0 THEN CAST(id - 1 AS STRING) END AS parent")
    rows = H.hierarchy_walk(spark, chain, paths=False).collect()
    assert {(int(r.name), r.depth, tuple(r.places), r.size) for r in rows} == {(i, i, (i + 1,), 1000 - i) for i in range(1000)}
    assert len(calls) <= 2 * 11 + 6
    calls.clear()
    assert H.hierarchy_closure(spark, chain.filter("CAST(name AS INT) < 100")).count() == 99 * 100 // 2
    assert len(calls) <= 9


def test_intervals_tell_descendants(spark):
    rows = [(f"t{i}", f"t{(i - 1) // 3}" if i else None) for i in range(40)]
    got = {r.name: r for r in H.hierarchy_walk(spark, spark.createDataFrame(rows, "name string, parent string")).collect()}
    for a in got.values():
        low = a.places[0]
        assert {b.name for b in got.values() if low <= b.places[0] < low + a.size} == {b.name for b in got.values() if a.name in b.path}
