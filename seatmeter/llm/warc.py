"""WARC archives as a chunked record table.

An archive is stored as rows (archive, record_no, record_id, chunk_no, n_chunks,
data, digest) of a Parquet table in the shared folder: concatenating ``data`` in
the order of (record_no, chunk_no) gives the archive's WARC/1.1 bytes. A record
is streamed as chunks of a bounded size, so no whole record is ever allocated
beside its input cell, and each chunk carries the SHA-256 of the payload up to
its own end. The reader keeps one running digest per record and checks it at
every chunk, and against the record's header at the end.

Spark's writer commits the table, so a lost executor or a retried task leaves
no partial archive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20
LEAST_PAYLOAD = 100            # shorter payloads are never replaced by a revisit
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
# fixed value: the profile of a revisit record with an equal payload (WARC/1.1, 6.7.2)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

CHUNKS = ("archive int, record_no long, record_id string, chunk_no int, n_chunks int, data binary, digest string")
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def _urn(page_id) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def record_head(page_id, url: str | None, size: int, digest: str, refers_to) -> bytes:
    """Everything of a record before its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    target = "".join((url or "").splitlines())
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(lines).encode() + END + http


class _Rows:
    """Collects rows and hands them on as record batches of a bounded number of bytes."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.schema, self.rows, self.held = pa.schema(list(zip(names, types))), [], 0

    def add(self, row: tuple, size: int) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.held += size + 200
        return self.flush() if self.held >= 4 * CHUNK else None

    def flush(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        arrays = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _write(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    archive, record_no = TaskContext.get().partitionId(), -1
    out = _Rows(["archive", "record_no", "record_id", "chunk_no", "n_chunks", "data", "digest"],
                [pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string()])
    for batch in batches:
        page, url, html, digest, first = (batch.column(i) for i in range(5))
        for i in range(batch.num_rows):
            record_no += 1
            page_id, refers_to = page[i].as_py(), first[i].as_py()
            body = memoryview(html[i].as_buffer() or b"") if html[i].is_valid else memoryview(b"")
            head = record_head(page_id, url[i].as_py(), len(body), digest[i].as_py(), refers_to)
            stored = body[:0] if refers_to is not None else body
            n_chunks = max(1, -(-len(stored) // chunk))
            running = hashlib.sha256()
            for k in range(n_chunks):
                part = stored[k * chunk: (k + 1) * chunk]
                running.update(part)
                data = b"".join((head if k == 0 else b"", part, END if k == n_chunks - 1 else b""))
                full = out.add((archive, record_no, _urn(page_id), k, n_chunks, data, running.hexdigest()), len(data))
                if full is not None:
                    yield full
    rest = out.flush()
    if rest is not None:
        yield rest


def write_archives(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = LEAST_PAYLOAD) -> None:
    """Write one record per page (page_id, url, html; further columns are ignored) to ``path``.

    A null html is an empty payload. Of pages whose payloads are equal and of at least ``least``
    bytes the smallest page_id is a response, the others revisit it; rows that repeat that page_id
    are responses too. A page without page_id is always a response and never referred to.
    """
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("html")).withColumn("digest", F.sha2("html", 256))
    # digests only: the payloads themselves are moved once, by page, never by (perhaps very common) digest
    small = base.filter((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("digest", "page_id")
    firsts = small.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last")
    revisits = small.join(firsts, "digest").filter("page_id > first").select("page_id", "digest", "first").distinct()
    (base.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "first")
     .mapInArrow(partial(_write, chunk=chunk), CHUNKS).write.option("compression", "zstd").parquet(path))


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def _page(urn: str | None):
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "none") else int(number)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse records from chunk rows that arrive in the order of (archive, record_no, chunk_no)."""
    out = _Rows(["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
                [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()])
    head: dict[str, str] = {}
    block = size = got = 0
    running = None
    for batch in batches:
        number, count, data, digest = (batch.column(batch.schema.get_field_index(c)) for c in ("chunk_no", "n_chunks", "data", "digest"))
        for i in range(batch.num_rows):
            view, k, n = memoryview(data[i].as_buffer()), number[i].as_py(), count[i].as_py()
            if k == 0:
                raw = bytes(view)                    # the first chunk holds the whole head, whatever its url's length
                cut = raw.index(END)
                http = raw.index(END, cut + 4) + 4
                head = _fields(raw[:cut])
                size = int(_fields(raw[cut + 4: http - 4])["content-length"])
                block, got = int(head["content-length"]) - (http - cut - 4), 0
                view, running = view[http:], hashlib.sha256()
            if k == n - 1:
                if bytes(view[-4:]) != END:
                    raise ValueError(f"record {head.get('warc-record-id')}: no end of record")
                view = view[:-4]
            running.update(view)
            got += len(view)
            if running.hexdigest() != digest[i].as_py():
                raise ValueError(f"record {head.get('warc-record-id')}: chunk {k} differs from its digest")
            if k < n - 1:
                continue
            named = head["warc-payload-digest"].removeprefix("sha256:")
            response = head["warc-type"] == "response"
            if got != block or response and (got != size or running.hexdigest() != named):
                raise ValueError(f"record {head.get('warc-record-id')}: payload differs from its header")
            full = out.add((_page(head["warc-record-id"]), size, named, head["warc-type"],
                            _page(head.get("warc-refers-to")), head["warc-target-uri"]), 200)
            if full is not None:
                yield full
    rest = out.flush()
    if rest is not None:
        yield rest


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Records of a single chunk are read where they lie. Only records of several chunks are brought
    together, by record, and streamed in chunk order.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)
    one = chunks.filter("n_chunks = 1").select("chunk_no", "n_chunks", "data", "digest")
    many = (chunks.filter("n_chunks > 1").repartition("archive", "record_no")
            .sortWithinPartitions("archive", "record_no", "chunk_no").select("chunk_no", "n_chunks", "data", "digest"))
    return one.mapInArrow(_read, RECORDS).unionAll(many.mapInArrow(_read, RECORDS))
