"""WARC archives: writing captures, reading records, assembling transactions.

A capture is written as three records, each a gzip member of its own: the
request, the response (or a revisit without payload, when an equal payload of
at least ``MIN_REVISIT_BYTES`` belongs to a capture with a larger id) and a
metadata record; request and metadata name the response in WARC-Concurrent-To.
``read_records`` gives one row per record of any such archives, and
``assemble`` joins request, response and metadata through the concurrent-to
identifiers, in whichever direction these point, into one nested row per capture.

Scale: the captures of equal payloads are found by a partial aggregate over
digests; the join that marks revisits deals each digest over ``SALTS`` parts, so
one payload that a third of all pages share stays divided.  A task streams its
rows into one archive of its own name; only archives in the manifest count, so
lost and repeated attempts leave nothing in the data.  Reading streams record
by record.  Assembly aggregates before it joins: of several requests or
metadata records of one capture it keeps the first by record id, and the count.

Defined results: null html is an empty payload; null urls give records without
a target; a null page_id is always a response and refers to nothing; repeated rows
are captures of their own, and all rows with the largest page_id are
responses; an empty table gives no archive.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart.llm.common import record_batch, shuffle_partitions, written

MIN_REVISIT_BYTES = 1000
SALTS = 32
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2_000


def _record(kind: str, identifier: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{identifier}>"), ("WARC-Date", DATE), *fields, ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + squeeze.flush()


def _target(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")


def capture_records(
    page_id: int | None, number: str, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> Iterator[bytes]:
    """The three records of a capture, compressed."""
    name = f"urn:x-page:{'' if page_id is None else page_id}:{digest}:{number}"
    target = _target(url)
    try:
        parts = urlsplit(target or "")
        host, path = parts.netloc, (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    except ValueError:
        host, path = "", "/"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    same = [("WARC-Target-URI", target)]
    answer = [*same, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    yield _record("request", f"{name}:request", [*same, ("WARC-Concurrent-To", f"<{name}>"), ("Content-Type", "application/http;msgtype=request")],
                  f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    if refers_to is None:
        yield _record("response", name, answer, http + payload)
    else:
        yield _record("revisit", name, [*answer, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}:{digest}>")], http)
    yield _record("metadata", f"{name}:metadata", [*same, ("WARC-Concurrent-To", f"<{name}>"), ("Content-Type", "application/warc-fields")],
                  f"page-id: {'' if page_id is None else page_id}\r\nurl-known: {int(url is not None)}\r\n".encode())


def marked_revisits(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (page_id of the response, for revisits)."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    source = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    source = source.withColumn("digest", F.sha1("payload"))
    large = source.where(F.octet_length("payload") >= min_bytes)
    shared = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least")).where("least < keeper")
    spread = shared.select("digest", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = source.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    found = salted.join(spread, ["digest", "salt"], "left")
    refers = F.when(F.col("page_id") < F.col("keeper"), F.col("keeper"))  # a shared digest has min_bytes
    return found.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write all captures below ``path`` (a URI that all executors reach)."""

    def run(batches):
        store, folder = pafs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        n = 0
        with store.open_output_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20) as out:
            for batch in batches:
                columns = [batch.column(k) for k in range(5)]
                for i in range(batch.num_rows):
                    page_id, url, payload, digest, refers_to = (c[i].as_py() for c in columns)
                    for record in capture_records(page_id, f"{part}.{n}", url, payload, digest, refers_to):
                        out.write(record)
                    n += 1
        if not n:
            store.delete_file(f"{folder}/{name}")
            return
        yield record_batch({"name": ([name], pa.string()), "captures": ([n], pa.int64())})

    marked_revisits(pages, **options).mapInArrow(run, "name string, captures long").write.parquet(f"{path}/manifest")


class _Members:
    """Bytes of a file of gzip members, in order, a bounded number at a time."""

    def __init__(self, stream):
        self.stream, self.buffer, self.raw = stream, b"", b""
        self.unpack = zlib.decompressobj(31)
        self.over = False

    def _more(self) -> bool:
        while not self.over:
            if not self.raw:
                self.raw = self.stream.read(READ_BYTES)
                if not self.raw:
                    self.over = True
                    return False
            got = self.unpack.decompress(self.raw, READ_BYTES)
            self.raw = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.raw = self.unpack.unused_data
                self.unpack = zlib.decompressobj(31)
            if got:
                self.buffer += got
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without ``mark``; None at the end of the file."""
        start = 0
        while (at := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        found, self.buffer = self.buffer[:at], self.buffer[at + len(mark) :]
        return found

    def exactly(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            self.buffer = b""
            if not self._more():
                raise EOFError("the archive ends within a record")
            parts.append(self.buffer)
            have += len(self.buffer)
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields with lower-case names, block) of each record of one archive."""
    members = _Members(stream)
    while (head := members.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        block = members.exactly(int(fields.get("content-length", 0)))
        members.exactly(4)  # the two line ends after a block
        yield fields, block


RECORD = (
    "record_id string, type string, target string, concurrent_to string, refers_to string, "
    "payload_bytes long, payload_digest string, body binary"
)


def read_records(spark: SparkSession, path: str, *, bodies: bool = True) -> DataFrame:
    """One row per record.  ``payload_bytes`` and ``payload_digest`` are of the full HTTP payload: taken
    from a response's bytes, from a revisit's headers.  ``body`` is the payload of a response, else the block."""

    def run(batches):
        store, folder = pafs.FileSystem.from_uri(path)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for fields, block in records(stream):
                        kind = fields.get("warc-type")
                        size = digest = None
                        body = block
                        if kind in ("response", "revisit"):
                            head, _, body = block.partition(b"\r\n\r\n")
                            if kind == "response":
                                size, digest = len(body), hashlib.sha1(body).hexdigest()
                                if fields.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                                    raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
                            else:
                                size = int(_fields(head).get("content-length", 0))
                                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        rows.append((*(fields.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-type", "warc-target-uri", "warc-concurrent-to", "warc-refers-to")), size, digest, body if bodies else None))
                        held += len(body) if bodies else 0
                        if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                            yield _rows(rows)
                            rows, held = [], 0
        if rows:
            yield _rows(rows)

    archives = spark.read.parquet(f"{path}/manifest").select("name")
    return archives.repartition(shuffle_partitions(spark), "name").mapInArrow(run, RECORD)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["record_id", "type", "target", "concurrent_to", "refers_to", "payload_bytes", "payload_digest", "body"]
    types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
    return record_batch({n: (list(c), t) for n, t, c in zip(names, types, zip(*rows))})


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: record_id, response (or revisit), request and metadata as structs, and counts.

    A record belongs to the response that it names in concurrent_to, or that
    names it.  A capture without request or metadata has nulls there; records
    that belong to no response are left out.
    """
    first = F.col("type").isin("response", "revisit")
    answers = found.where(first).select(
        "record_id", F.struct("type", "target", "refers_to", "payload_bytes", "payload_digest", "body").alias("response"),
        F.col("concurrent_to").alias("names"),
    )
    others = found.where(F.col("type").isin("request", "metadata"))
    own = F.struct("record_id", "target", "body")
    named = others.where(F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("capture"), "type", own.alias("r"))
    naming = answers.where(F.col("names").isNotNull()).select(F.col("record_id").alias("capture"), F.col("names").alias("record_id"))
    by_name = others.join(naming.hint("merge"), "record_id").select("capture", "type", own.alias("r"))
    request, metadata = F.col("type") == "request", F.col("type") == "metadata"
    joined = named.unionByName(by_name).groupBy("capture").agg(
        F.min_by("r", F.when(request, F.col("r.record_id"))).alias("request"),
        F.min_by("r", F.when(metadata, F.col("r.record_id"))).alias("metadata"),
        F.count_if(request).alias("n_requests"), F.count_if(metadata).alias("n_metadata"),
    )
    whole = answers.join(joined.hint("merge"), F.col("record_id") == F.col("capture"), "left")
    zero = F.lit(0).cast("long")
    return whole.select(
        "record_id", "response", "request", "metadata",
        F.coalesce("n_requests", zero).alias("n_requests"), F.coalesce("n_metadata", zero).alias("n_metadata"),
    )


def warc_digest(pages: DataFrame, path: str, **options) -> DataFrame:
    """The contract's columns, one row per capture, from archives written to ``path`` and read back."""
    write_archives(pages, path, **options)
    # written once: the archives are read a single time, and Spark sees the records' size and not the manifest's
    found = written(read_records(pages.sparkSession, path, bodies=False), "warc-records")
    captures = assemble(found)

    def page_of(urn):
        return F.expr(f"try_cast(split({urn}, ':')[2] AS long)")

    return captures.select(
        page_of("record_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        page_of("response.refers_to").alias("refers_to"),
        F.col("request").isNotNull().alias("has_request"), F.col("metadata").isNotNull().alias("has_metadata"),
    )
