"""Every registered query against its DuckDB oracle, at sf0.001."""

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry
from docweave.plans import catalog

QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.QUERIES}
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
