import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docweave.session import get_session

    s = get_session("local[4]", app="docweave-tests")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    yield s


def page_df(spark, *pages, category="t"):
    """Shred hand-written pages: ``(source_path, html)`` pairs or bare html."""
    from docweave.operators.shred import shred

    rows = []
    for i, p in enumerate(pages):
        path, html = p if isinstance(p, tuple) else (f"p{i}/index.html", p)
        rows.append((category, path, html))
    df = spark.createDataFrame(rows, "category string, source_path string, html string")
    return shred(df, keep=["category", "source_path"], spread=False)
