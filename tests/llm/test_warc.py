"""WARC: round trips, ranges, damage, revisits."""

import base64
import gzip
import hashlib
import io

import pytest

from docweave.llm import common, warc
from tests.llm.brute import read


def brute(rows):
    first = {}
    for i, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, h in rows:
        data, to = (h or "").encode(), first.get(h or "")
        revisit = to is not None and i != to
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    assert all(r["intact"] for r in rows)
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/sf{sf}"
    assert got(warc.q_op4(spark, d)) == brute([(r["page_id"], r["html"]) for r in read(d, "pages")])


def test_odd_rows(spark):
    rows = [(3, None, "x"), (1, "u\r\n é", "x"), (2, "u", None), (5, "u", ""), (None, "u", "x"), (None, None, "only"), (7, "u", "x" * 3_000_000),
            (8, "u", "WARC/1.0\r\n\r\n\x1f"), (1, "u", "x"), (-9, "u", "é😀")]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], "page_id long, url string, html string, digest int, payload string")
    planned = warc.plan_records(df)
    manifest = warc.write_archives(planned, common.shared_folder(spark, "warc"))
    back = warc.read_archives(manifest, range_bytes=1000)
    assert got(back) == brute([(r[0], r[2]) for r in rows])
    whole = {r["page_id"]: bytes(r["payload"]).decode() for r in back.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert whole[7] == "x" * 3_000_000 and whole[-9] == "é😀" and whole[1] == "x"
    empty = warc.write_archives(warc.plan_records(df.limit(0)), common.shared_folder(spark, "warc"))
    assert warc.read_archives(empty).count() == 0


def test_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r["page_id"]: r["record_type"] for r in warc.plan_records(df, min_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def _file(n):
    return [warc._page_member(i, "u", bytes([i % 251]) * (i * 37 % 900) + b"\x1f\x8b\x08", "response", None, "s") for i in range(n)]


@pytest.mark.parametrize("step", [1, 3, 50, 333, 10**6])
def test_every_record_is_owned_by_one_range(step):
    data = b"".join(_file(12))
    ids = [h["warc-record-id"] for s in range(0, len(data), step) for _, h, _ in warc.members(io.BytesIO(data), len(data), s, s + step)]
    assert ids == [f"<urn:page:{i}>" for i in range(12)]


def test_false_magic_and_damage():
    parts = _file(6)
    stored = gzip.compress(b"not a warc record", mtime=0)
    data = b"".join(parts[:2]) + stored + warc.MAGIC * 3 + parts[2] + parts[3][:40] + b"".join(parts[4:])
    ids = [h["warc-record-id"] for _, h, _ in warc.members(io.BytesIO(data), len(data), 0, len(data))]
    assert ids == [f"<urn:page:{i}>" for i in (0, 1, 2, 4, 5)]
