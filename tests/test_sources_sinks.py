import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docweave.sources import files as S
from docweave.sources import sinks as K


def _tree(root, files):
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(text)


def test_scan_lists_each_index_once_and_excludes(spark):
    root = tempfile.mkdtemp(prefix="dw-scan-", dir="/tmp")
    _tree(root, {
        "Developer/A/index.html": "<h1>class A</h1>",
        "Developer/A/B/index.html": "<h1>enum B</h1>",
        "Developer/A/other.html": "x",
        "Runtime/F/index.html": "<h1>function F</h1>",
        "Plugins/P/index.html": "<h1>P</h1>",
    })
    roots = {"developer": f"{root}/Developer", "runtime": f"{root}/Runtime", "plugins": f"{root}/Plugins"}
    got = sorted((r.category, r.source_path) for r in S.scan_pages(spark, roots, exclude=[" Plugins ", ""]).collect())
    assert got == [("developer", "A/B/index.html"), ("developer", "A/index.html"), ("runtime", "F/index.html")]
    pages = S.read_pages(spark, roots, exclude=["plugins"])
    assert sorted(r.html for r in pages.collect())[0].startswith("<h1>")
    # a page that is not valid UTF-8 is read as null html (a dead letter downstream)
    os.makedirs(f"{root}/Runtime/Bad")
    with open(f"{root}/Runtime/Bad/index.html", "wb") as f:
        f.write(b"<h1>\xff\xfe broken</h1>")
    bad = S.read_pages(spark, roots).filter("source_path = 'Bad/index.html'").collect()
    assert len(bad) == 1 and bad[0].html is None


def test_page_index_round_trip(spark):
    d = tempfile.mkdtemp(prefix="dw-idx-", dir="/tmp")
    idx = spark.createDataFrame([('A/"q"/index.html',), ("Ü/index.html",)], "source_path string")
    S.page_index_lines(idx).write.mode("overwrite").text(f"{d}/idx")
    with open(os.path.join(d, "blank.txt"), "w") as f:
        f.write("\n   \n")
    back = S.read_page_index(spark, f"{d}/idx")
    assert sorted(r[0] for r in back.collect()) == sorted(['A/"q"/index.html', "Ü/index.html"])


def test_read_entities_tolerates_bad_lines_and_missing_folders(spark):
    d = tempfile.mkdtemp(prefix="dw-ent-", dir="/tmp")
    os.makedirs(f"{d}/json_developer_entities")
    with open(f"{d}/json_developer_entities/all_developer_entities.ndjson", "w") as f:
        f.write(json.dumps({"name": "A", "source_path": "a"}) + "\n")
        f.write('{"name": "B", "sour\n')
        f.write(json.dumps({"name": "C", "navigation": "x", "source_path": "c"}) + "\n")
    df = S.read_entities(spark, [f"{d}/json_developer_entities", f"{d}/json_missing_entities"])
    rows = df.select("_bad", "_e.name").collect()
    assert sorted((r[0], r[1]) for r in rows) == [(False, "A"), (False, "C"), (True, None)]


def test_write_ndjson_keeps_nulls(spark):
    d = tempfile.mkdtemp(prefix="dw-out-", dir="/tmp")
    df = spark.createDataFrame([("developer", "a", None)], "category string, source_path string, module string")
    K.write_ndjson(df, f"{d}/out", partition_by=["category"])
    lines = spark.read.text(f"{d}/out").collect()
    assert json.loads(lines[0][0]) == {"source_path": "a", "module": None}


def test_line_numbers_dense_per_group(spark):
    rows = [("a" if i % 3 else "b", f"p{i % 7}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "category string, source_path string, line_no long").repartition(5)
    got = K.line_numbers(df, "category", ["line_no"]).collect()
    for cat in ("a", "b"):
        mine = sorted((r.line_no, r.line) for r in got if r.category == cat)
        assert [l for _, l in mine] == list(range(len(mine)))
    pos = K.position_index(df, "category", order=["line_no"]).collect()
    assert len(pos) == 14


def test_read_hierarchy_last_line_wins(spark):
    d = tempfile.mkdtemp(prefix="dw-hier-", dir="/tmp")
    place = lambda n: {"source_path": "h", "pos": n}
    with open(f"{d}/class_hierarchy.ndjson", "w") as f:
        f.write(json.dumps({"name": "A", "link": "a1", "parent": None, "depth": 0, "ord": place(1)}) + "\n")
        f.write(json.dumps({"name": "B", "link": "b", "parent": "A", "depth": 1, "ord": place(2)}) + "\n")
        f.write("broken\n")
        f.write(json.dumps({"name": "A", "link": "a2", "parent": None, "depth": 0, "ord": place(3)}) + "\n")
    h = {r.name: r for r in S.read_hierarchy(spark, d).collect()}
    assert h["A"].link == "a2" and h["A"].ord.pos == 3 and h["B"].parent == "A" and len(h) == 2


def test_positions_address_the_written_lines(spark):
    d = tempfile.mkdtemp(prefix="dw-pos-", dir="/tmp")
    rows = [("x", p) for p in "KMQZAB"] + [("y", "A"), ("y", "A"), ("y", "C")]
    K.write_sorted_ndjson(spark.createDataFrame(rows, "category string, source_path string").repartition(4), f"{d}/out", ["source_path"], ["category"])
    at = K.written_positions(spark, f"{d}/out").collect()
    assert len(at) == 8
    for r in at:
        with open(f"{d}/out/category={r.category}/{r.file}", encoding="utf-8") as f:
            lines = f.read().splitlines()
        assert json.loads(lines[r.line])["source_path"] == r.source_path
        assert [json.loads(x)["source_path"] for x in lines] == sorted(json.loads(x)["source_path"] for x in lines)


def test_page_tree_round_trip(spark):
    d = tempfile.mkdtemp(prefix="dw-tree-", dir="/tmp")
    pages = spark.createDataFrame([("c", "a/index.html", "é<h1>"), ("c", "b/c/index.html", "<p>x")], "category string, source_path string, html string")
    assert K.write_page_tree(pages, d) == 2
    got = sorted(tuple(r) for r in S.read_pages(spark, {"c": f"{d}/c"}).collect())
    assert got == [("c", "a/index.html", "é<h1>"), ("c", "b/c/index.html", "<p>x")]


def test_exclusion_list_normalised(spark):
    df = spark.createDataFrame([("Editor",), ("runtime",), ("plugins",)], "category string")
    got = sorted(r[0] for r in S.exclude_categories(df, [" EDITOR ", "", "Plugins"]).collect())
    assert got == ["runtime"]


def test_hidden_folders_empty_pages_and_roots(spark, tmp_path):
    from docweave.sources import page_source

    base = tmp_path / "tree x%41"
    for path in ("index.html", "_a/index.html", ".b/c d/index.html", "e/f/g/index.html", "e/other.html"):
        (base / path).parent.mkdir(parents=True, exist_ok=True)
        (base / path).write_text("" if "_a" in path else path)
    want = {(p, "" if "_a" in p else p) for p in ("index.html", "_a/index.html", ".b/c d/index.html", "e/f/g/index.html")}
    for root in (str(base), f"file:{base}", f"file://{base}", f"{base}/"):
        assert {(r.source_path, r.html) for r in S.read_pages(spark, {"c": root}).collect()} == want
    listing = S.scan_pages(spark, {"c": str(base)}).collect()
    assert sorted(r.path for r in listing) == sorted(f"file:{base}/{p}" for p, _ in want)
    for tasks in (1, 2, 5, 100):
        parts = page_source.plan({"c": f"file:{base}", "d": f"file:{base}/e"}, tasks)
        found = [(c, p) for part in parts for c, _, p, _ in page_source.pages(page_source.Folders(part), "index.html")]
        assert len(parts) <= tasks and sorted(found) == sorted([("c", p) for p, _ in want] + [("d", "f/g/index.html")])
    with pytest.raises(Exception, match="no such folder"):
        S.scan_pages(spark, {"c": str(base / "none")}).count()


def test_stream_of_pages(spark, tmp_path):
    import time

    base = tmp_path / "pages"

    def put(name, text):
        (base / name).mkdir(parents=True, exist_ok=True)
        (base / name / "index.html").write_text(text)

    def run():
        time.sleep(1.2)
        q = S.stream_pages(spark, {"c": str(base)}).writeStream.trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).format("json").start(str(tmp_path / "out"))
        q.awaitTermination()
        return sorted(r.source_path for r in spark.read.json(str(tmp_path / "out")).collect())

    put("_one", "1")
    put("two", "")
    assert run() == ["_one/index.html", "two/index.html"]
    put("three", "3")
    assert run() == ["_one/index.html", "three/index.html", "two/index.html"]
    assert len(run()) == 3


def test_relative_path_outside_its_root(spark):
    from pyspark.sql import functions as F

    from docweave.functions.text import relative_path

    df = spark.createDataFrame([("/a/b/c",), (None,)], "p string")
    assert [r[0] for r in df.select(relative_path(F.col("p"), "/a")).collect()] == ["b/c", None]
    with pytest.raises(Exception, match="is not below"):
        df.select(relative_path(F.col("p"), "/x")).collect()
