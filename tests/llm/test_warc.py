"""WARC archives: written, read back and assembled, against the rule itself."""

import gzip
import hashlib
import io

from hiremart.llm import warc as W
from hiremart.llm.common import work_dir

SCHEMA = "page_id long, url string, html string, digest string, salt int, keeper long"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, 2) for i, u, h in rows], SCHEMA)


def expected(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            largest[h] = max(largest.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        keeper = largest.get(h)
        revisit = i is not None and keeper is not None and i < keeper
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def run(spark, rows):
    found = W.warc_digest(frame(spark, rows), work_dir(spark, "w"))
    got = found.collect()
    assert all(r.has_request and r.has_metadata for r in got)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)


def test_revisits_nulls_and_line_ends(spark):
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60, "x" * 1000
    rows = [(1, "http://a/", big), (9, "http://b/?q=1", big), (5, "http://ü.example/pfad mit\r\nzeile", big), (2, None, None), (3, "::bad::[", ""),
            (4, "u", "small"), (6, "u", "small"), (7, "u", other), (8, "u", other), (8, "u", other), (None, "n", other), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    assert run(spark, rows) == expected(rows)


def test_a_hot_payload_and_long_records(spark):
    rows = [(k, f"http://h/{k}", "same" * 300) for k in range(200)] + [(1000, "http://long/", "long page " * 300_000)]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_archives_are_plain_warc_and_bodies_come_back(spark):
    path = work_dir(spark, "w")
    W.write_archives(frame(spark, [(1, "http://a/b?c=d", "héllo")]), path)
    name = spark.read.parquet(f"{path}/manifest").first()["name"]
    store, folder = W.pafs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{folder}/{name}", compression=None) as f:
        text = gzip.GzipFile(fileobj=io.BytesIO(f.read())).read().decode()
    assert text.count("WARC/1.1\r\n") == 3 and "GET /b?c=d HTTP/1.1\r\nHost: a\r\n" in text
    r = W.assemble(W.read_records(spark, path)).first()
    assert bytes(r.response.body).decode() == "héllo" and r.response.target == "http://a/b?c=d"
    assert (r.n_requests, r.n_metadata) == (1, 1) and r.request.record_id.endswith(":request")


def test_assembly_in_both_directions(spark):
    rows = [
        ("r1", "response", "t", "q1"), ("q1", "request", "t", None),   # the response names its request
        ("r2", "response", "t", None), ("q2", "request", "t", "r2"), ("m2", "metadata", "t", "r2"), ("m3", "metadata", "t", "r2"),
        ("lost", "metadata", "t", "nowhere"), ("r3", "revisit", "t", None), ("w", "warcinfo", None, None),
    ]
    found = spark.createDataFrame([(i, k, t, c, None, 1, "d", b"") for i, k, t, c in rows], W.RECORD)
    got = {r.record_id: (r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_requests, r.n_metadata) for r in W.assemble(found).collect()}
    assert got == {"r1": ("q1", None, 1, 0), "r2": ("q2", "m2", 1, 2), "r3": (None, None, 0, 0)}


def test_records_are_not_broadcast(spark):
    """Spark must not take the records for as small as the manifest they are read from."""
    path = work_dir(spark, "w")
    W.write_archives(frame(spark, [(k, "http://a/", "x" * 2000) for k in range(20)]), path)
    plan = W.assemble(W.read_records(spark, path, bodies=False))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    plan = W.warc_digest(frame(spark, [(1, "u", "x")]), work_dir(spark, "w"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "MapInArrow" not in plan
