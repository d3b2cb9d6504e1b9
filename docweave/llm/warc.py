"""WARC archives: a writer, and a splittable reader.

Every record is a gzip member of its own.  The reader deals byte ranges of the
files to tasks.  A task scans its range for gzip magic, accepts a candidate only
if it decodes to a WARC header, and owns the records whose member starts inside
its range, reading past the range's end for the last of them.  From one member
it goes on to the next without scanning; a damaged member sends it back to
scanning.  So no index is needed and a large file is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common

MAGIC = b"\x1f\x8b\x08"
#: A writer task begins a new file beyond so many bytes.
FILE_BYTES = 512 << 20
#: Bytes of an archive that one reader task is dealt.
RANGE_BYTES = 8 << 20
#: Bytes read from the store at a time.
READ_BYTES = 1 << 20
#: Payloads from so many bytes up are written once and then revisited.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("page_id long, record_type string, refers_to long, target_uri string, payload_bytes long, "
                 "payload_digest string, intact boolean, payload binary")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _page_member(page_id, url, payload: bytes, record_type: str, refers_to, salt: str) -> bytes:
    """A response with an HTTP head and the payload, or a revisit with the head
    alone.  Characters that a header can't hold are percent-encoded in the uri."""
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, salt)}"
    headers = [("WARC-Type", record_type), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE),
               ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest32(payload)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url)))
    if record_type == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(headers, http if record_type == "revisit" else http + payload)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, payload, record_type, refers_to)``: of the rows with
    equal payloads of at least ``min_bytes`` bytes the one with the smallest
    page_id is the response and the others revisit it.

    A null html is an empty payload.  Rows that repeat the smallest page_id with
    the same payload are all responses; rows without a page_id revisit like any
    other, unless no row of that payload has one.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Written: the join's sides then come straight from a shuffle, and Spark can split a hot payload's rows.
    first = common.written(rows.groupBy("digest").agg(F.min("page_id").alias("first_id")), "firsts")
    revisit = (F.length("payload") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "digest").select(
        "page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records to ``folder`` (shared by all executors), a file or more
    per task; returns the manifest ``(path, bytes, records)``.

    A task names its files anew at each attempt and the manifest names those of
    the attempts that succeeded, so a lost executor leaves only files that
    nobody reads.
    """

    def write(batches):
        stamp, out, size, n, path = uuid.uuid4().hex, None, 0, 0, None
        done = {"path": [], "bytes": [], "records": []}

        def close():
            out.close()
            for k, v in (("path", path), ("bytes", size), ("records", n)):
                done[k].append(v)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size >= file_bytes:
                    if out is not None:
                        close()
                    path, n = f"{folder}/{stamp}-{len(done['path'])}.warc.gz", 0
                    store, local = common.open_store(path)
                    store.create_dir(local.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(local, compression=None)
                    info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                data = _page_member(row["page_id"], row["url"], row["payload"], row["record_type"], row["refers_to"], f"{path}#{n}")
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict(done, schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return common.written(records.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Random reads of a file through one buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.base, self.data = file, size, 0, b""

    def at(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        if not (self.base <= offset and offset + n <= self.base + len(self.data)):
            self.file.seek(offset)
            self.base, self.data = offset, self.file.read(max(n, READ_BYTES))
        return self.data[offset - self.base:offset - self.base + n]


def _decode(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and the offset after it; None if there
    is no whole member with a WARC header."""
    unpack, parts, offset, step, checked = zlib.decompressobj(31), [], at, 4096, False
    while not unpack.eof:
        chunk = window.at(offset, step)
        if not chunk:
            return None
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            return None
        if not checked and sum(map(len, parts)) >= 7:
            checked = True
            if not b"".join(parts).startswith(b"WARC/1."):
                return None
        offset += len(chunk)
        step = min(step * 2, READ_BYTES)
    return (b"".join(parts), offset - len(unpack.unused_data)) if checked else None


def _parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (names in lower case) and block; None if they don't add up."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        k, colon, v = line.decode("utf-8", "replace").partition(":")
        headers[k.strip().lower()] = v.strip()
    n = headers.get("content-length", "")
    if not gap or not n.isdigit() or len(rest) != int(n) + 4 or "warc-type" not in headers:
        return None
    return headers, rest[:int(n)]


def members(file, size: int, start: int, end: int):
    """``(offset, headers, block)`` of the records whose member starts in ``start..end``."""
    window, at, synced = _Window(file, size), start, False
    while at < min(end, size):
        if not synced:
            chunk = window.at(at, min(READ_BYTES, end + len(MAGIC) - 1 - at))
            found = chunk.find(MAGIC)
            if found < 0:
                at += max(1, len(chunk) - len(MAGIC) + 1)
                continue
            at += found
            if at >= end:
                return
        decoded = _decode(window, at)
        parsed = _parse(decoded[0]) if decoded else None
        if parsed is None:
            at, synced = at + 1, False
            continue
        yield at, *parsed
        at, synced = decoded[1], True


def _page_id(urn: str | None):
    m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(m[1]) if m else None


def _row(headers: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    length = re.search(rb"(?i)^content-length: *([0-9]+)", http, re.M)
    own = stated if revisit else digest32(payload)
    return {"page_id": _page_id(headers.get("warc-record-id")), "record_type": headers["warc-type"],
            "refers_to": _page_id(headers.get("warc-refers-to")), "target_uri": headers.get("warc-target-uri"),
            "payload_bytes": int(length[1]) if revisit and length else len(payload), "payload_digest": own,
            "intact": own == stated, "payload": None if revisit else payload}


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the files ``(path, bytes)``, each file
    in ranges of ``range_bytes``.  ``payload`` is null for revisits, and
    throughout without ``payloads``; a revisit's length and digest are those its
    headers state, a response's are computed, and ``intact`` tells whether the
    stated digest agrees.  Columns of the manifest other than these two are
    ignored; no file, no rows."""
    spark = manifest.sparkSession
    ranges = manifest.select("path", "bytes", F.explode(F.expr(
        f"IF(bytes > 0, sequence(0L, bytes - 1, {range_bytes}L), cast(array() AS array<bigint>))")).alias("start"))
    tasks = spark.sparkContext.defaultParallelism * 4
    ranges = ranges.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                store, path = common.open_store(r["path"])
                rows, held = [], 0
                with store.open_input_file(path) as file:
                    for _, headers, block in members(file, r["bytes"], r["start"], r["start"] + range_bytes):
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        row = _row(headers, block)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"")
                        if held > 16 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.mapInArrow(read, RECORD_SCHEMA)


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = write_archives(plan_records(pages), common.shared_folder(spark, "warc"))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


common.by_value(__name__)
