"""URL filters: patterns, hosts, tokens, and the query against its SQL."""

import re

import pytest

from docweave.llm import url_filters as uf
from tests.oracle_compare import compare, duck


def test_tokens_and_regex():
    assert uf.literal_tokens("||example.org/en/1") == ["en", "example", "org"]
    assert uf.literal_tokens("||org/") == ["org"]
    assert uf.literal_tokens("ads*banner^") == []
    assert uf.literal_tokens(".exe|") == ["exe"]
    assert re.search(uf.to_regex("||example.org/").replace(r"\z", r"\Z"), "a.example.org/x")
    assert not re.search(uf.to_regex("||example.org/"), "badexample.org/x")


URLS = [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/x", "", "", None, "allow"),
    ("http://EXAMPLE.org/es/1?x=://y", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://a.example.org/en/12#t", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
    ("http://notorg/es/", "notorg", "/es/", None, "allow"), ("http://x.org", "x.org", "", None, "allow"),
    ("://x.com/de/", "x.com", "/de/", "com/de/", "block"), ("http://x.com/DE/", "x.com", "/DE/", None, "allow"),
    ("http://spam-farm.example.net/a", "spam-farm.example.net", "/a", None, "block"),
    ("http://xspam-farm.example.net/a", "xspam-farm.example.net", "/a", None, "block"),
    ("http://spam-farm.example.org/es/", "spam-farm.example.org", "/es/", "example.org/es/", "block"),
    ("http://x.com/fr/a.exe", "x.com", "/fr/a.exe", "com/fr/", "allow"), ("http://x.net/a.exe", "x.net", "/a.exe", None, "block"),
    ("http://é.com/de/\nx", "é.com", "/de/\nx", "com/de/", "block"),
]


def test_cases(spark):
    rows = [(i if i % 5 else None, u[0], "best", "host") for i, u in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, best string, host string")
    out = uf.judge_urls(df, uf.QUERY_RULES + uf.METHOD_RULES)
    assert sorted(out.columns) == sorted(["page_id", "url", "best", "host", "path", "rule", "verdict"])
    got = sorted(((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()), key=repr)
    assert got == sorted(URLS * 2, key=repr)


def test_rules_without_token_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.b/xadsx"), (2, "http://a.b/x")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in uf.judge_urls(df, [uf.Rule("ads", "block", 1)]).collect()}
    assert got == {1: "block", 2: "allow"}
    assert {r["verdict"] for r in uf.judge_urls(df, []).collect()} == {"allow"}
    assert uf.judge_urls(df.limit(0), uf.QUERY_RULES).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    ok, msg, _ = compare(spark, duck(d), "op9", uf.q_op9, uf.ORACLE_SQL, d)
    assert ok, msg


def test_no_python_in_plan(spark):
    plan = uf.q_op9(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
