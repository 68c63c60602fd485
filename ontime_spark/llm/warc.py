"""WARC archives: writing, and a sequential reader (operator 6).

Every record is a gzip member of its own. The reader takes an archive front to back: it feeds
raw bytes to an incremental inflater, starts a new one at each member's end, frames the record
by its Content-Length and compares the payload's SHA-256 with the digest in the header, so only
one record and one read buffer are in memory.

Records with equal payloads of at least ``REVISIT_BYTES`` are written once: the one with the
smallest id is a ``response``, the others are ``revisit`` records that name its record id and
carry no payload. Archives go to the shared folder, one or more files per task; a file gets its
name only when it is complete, and the job's own list of files is what is read, so a task that
is run again leaves no trace in the result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import materialize, scratch_path

#: Payloads of fewer bytes are always written.
REVISIT_BYTES = 100
#: Compressed bytes after which a task begins another archive.
FILE_BYTES = 256 << 20
READ_BYTES = 64 << 10
#: Uncompressed bytes of rows that a reading task hands on at once.
ROW_BYTES = 8 << 20
_NAMESPACE = uuid.UUID("6f2d7d1e-5a0b-4e43-9d3f-1f6c2a7b9e10")
_END = b"\r\n\r\n"


class DigestError(ValueError):
    """A payload is not what its record's header says."""


@dataclass
class Record:
    """A record as read: header fields (names in lower case) and payload."""

    headers: dict[str, str]
    payload: bytes


def record_id(key: str) -> str:
    """The WARC-Record-ID of a row's key (the same at every attempt)."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, key)}>"


def _field(value: str) -> str:
    """A header value on one line, as UTF-8 percent codes where it could not be."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def member(key: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record as one gzip member."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key)}",
             f"WARC-Target-URI: {_field(url or '')}", "WARC-Date: 2024-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Key: {key}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Key: {refers_to}"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(lines).encode() + _END + body + _END
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _members(read) -> Iterator[bytes]:
    """The uncompressed members of an archive, one at a time. ``read(n)`` gives raw bytes."""
    inflater, parts, fresh = zlib.decompressobj(31), [], True
    buffer = read(READ_BYTES)
    while buffer:
        parts.append(inflater.decompress(buffer))
        fresh = False
        if inflater.eof:
            yield b"".join(parts)
            buffer = inflater.unused_data or read(READ_BYTES)
            inflater, parts, fresh = zlib.decompressobj(31), [], True
        else:
            buffer = read(READ_BYTES)
    if not fresh:
        raise EOFError("the archive ends inside a record")


def read_records(read) -> Iterator[Record]:
    """The records of an archive. Raises ``DigestError`` for a payload that does not fit its
    digest and ``ValueError`` for broken framing."""
    for raw in _members(read):
        head, sep, rest = raw.partition(_END)
        lines = head.decode().split("\r\n")
        if not sep or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        if len(rest) != size + len(_END) or rest[size:] != _END:
            raise ValueError(f"record {headers.get('warc-record-id')}: length does not fit")
        payload = rest[:size]
        if headers["warc-type"] == "response":
            digest = hashlib.sha256(payload).hexdigest()
            if headers["warc-payload-digest"] != f"sha256:{digest}":
                raise DigestError(f"record {headers.get('warc-record-id')}: digest does not fit")
        yield Record(headers, payload)


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that holds ``uri`` (any scheme pyarrow knows), and the path in it."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row into archives under ``folder`` (shared by all executors) and
    return the list of files: path, records.

    A null payload is empty, a null url is empty. The id is written as text; a null id as the
    empty text. Rows with the same id and payload are written alike: of equal payloads all rows
    with the smallest id are responses."""
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    long = F.octet_length("html") >= REVISIT_BYTES
    first = (base.where(long).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("digest", "first"))
    # Few payloads repeat, but each may repeat without bound: only the keys are joined.
    revisits = (base.where(long).select("id", "digest").join(first, "digest")
                .where(F.col("id") > F.col("first")).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct())
    rows = base.join(revisits, (F.col("id") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "html", "digest", F.col("first").cast("string").alias("first"))

    def run(batches):
        fs, root = _filesystem(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}"
        out, seq, records, temp = None, 0, 0, ""

        def finish():
            nonlocal out
            out.close()
            path = f"{root}/{name}-{seq:04d}.warc.gz"
            fs.move(temp, path)
            out = None
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}-{seq:04d}.warc.gz"], "records": [records]},
                                              schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

        for batch in batches:
            for row in range(batch.num_rows):
                key, url, text, digest, refers = (batch.column(i)[row].as_py() for i in range(5))
                if out is None:
                    temp = f"{root}/.{name}-{seq:04d}-{context.taskAttemptId()}"
                    out, records = fs.open_output_stream(temp, compression=None), 0
                out.write(member(key, url, text.encode(), digest, refers))
                records += 1
                if out.tell() >= file_bytes:
                    yield finish()
                    seq += 1
        if out is not None:
            yield finish()

    return rows.mapInArrow(run, "path string, records long")


def read(files: DataFrame, path_col: str = "path") -> DataFrame:
    """The records of the archives: key, url, record_type, refers_to_key, payload_digest (bare
    hex, verified for responses), payload (empty for revisits). One archive is read by one task;
    ``write`` bounds its size."""
    schema = pa.schema([("key", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to_key", pa.string()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = _filesystem(uri)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream.read):
                        h = r.headers
                        rows.append((h.get("x-key"), h.get("warc-target-uri"), h["warc-type"], h.get("x-refers-to-key"),
                                     h["warc-payload-digest"].partition(":")[2], r.payload))
                        size += len(r.payload) + 500
                        if size >= ROW_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.select(path_col).mapInArrow(
        run, "key string, url string, record_type string, refers_to_key string, payload_digest string, payload binary")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back. A revisit's payload is that of the record
    it refers to; both are joined on the digest, of which each has one response payload."""
    pages = common.read(spark, sf_dir, "pages")
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    fs_folder(spark, folder)
    files = materialize(write(pages, folder), "warc-files")
    n = max(1, files.count())
    back = read(files.repartition(n, "path")).select(
        "key", "record_type", "refers_to_key", "payload_digest", F.octet_length("payload").cast("long").alias("own_bytes"))
    back = materialize(back, "warc-records")
    sizes = (back.where("record_type = 'response'").join(
        back.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest", "left_semi")
        .groupBy("payload_digest").agg(F.max("own_bytes").alias("bytes")))
    kind = pages.schema["page_id"].dataType
    whole = back.join(sizes, "payload_digest", "left")
    as_id = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return whole.select(
        as_id("key").alias("page_id"),
        F.when(F.col("record_type") == "response", F.col("own_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        "payload_digest", "record_type", as_id("refers_to_key").alias("refers_to"))


def fs_folder(spark, folder: str) -> None:
    """Create ``folder`` on its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


SQL = {"op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
    CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest"""}
