"""The driver contract of ``__spark_entry__``."""

import re

import __spark_entry__ as entry
from docweave.plans import catalog


def test_queries_and_oracles_pair_up():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(catalog.QUERIES) and set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(q) and set(o) <= set(q)
    for name, sql in o.items():
        assert sql.strip(), name


def test_query_names():
    for name in entry.queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
    for name in catalog.QUERIES:
        assert name != "pipeline" and not re.match(r"op\d+_", name), name
