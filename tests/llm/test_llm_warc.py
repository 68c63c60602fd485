"""WARC: round trips, framing and digest errors."""
import gzip
import hashlib
import io
import uuid

import pytest
from llm_cases import clash, frame
from pyspark.sql import functions as F

from ontime_spark.llm import warc
from ontime_spark.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def rows():
    big = "same payload " * 20
    return [(5, "http://a/ü", big), (3, "http://b", big), (9, None, big), (9, None, big), (1, "u\nv", "short"), (2, "w", "short"),
            (4, "x", None), (6, "y", ""), (7, "z", "é" * 50), (8, "z", "é" * 50), (None, "n", big), (10, "crlf", "a\r\n\r\nb" * 40),
            (11, "long", "0123456789" * 50000)]


def written(spark, data, **options):
    folder = scratch_path(spark, f"warc-test-{uuid.uuid4().hex}")
    warc.fs_folder(spark, folder)
    return warc.write(data, folder, **options).cache()


def test_round_trip(spark):
    data = rows()
    files = written(spark, clash(frame(spark, data, SCHEMA)), file_bytes=300)
    assert files.count() > 3 and files.agg(F.sum("records")).first()[0] == len(data)
    back = warc.read(files).collect()
    first = {}
    for d, _, h in data:
        if d is not None and h and len(h.encode()) >= 100:
            first[h] = min(d, first.get(h, d))
    want = []
    for d, u, h in data:
        raw = (h or "").encode()
        refers = first.get(h) if d is not None and first.get(h, d) != d else None
        want.append(("" if d is None else str(d), (u or "").replace("\n", "%0A"), "response" if refers is None else "revisit",
                     None if refers is None else str(refers), hashlib.sha256(raw).hexdigest(), b"" if refers else raw))
    assert sorted(((r.key, r.url, r.record_type, r.refers_to_key, r.payload_digest, bytes(r.payload)) for r in back), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    files = written(spark, frame(spark, [], SCHEMA))
    assert files.count() == 0 and warc.read(files).count() == 0


def test_each_record_is_a_member_any_tool_reads():
    body = b"<p>x</p>" * 30
    raw = warc.member("7", "http://x", body, hashlib.sha256(body).hexdigest(), None)
    assert gzip.decompress(raw).endswith(body + b"\r\n\r\n")
    both = raw + warc.member("8", "http://x", body, hashlib.sha256(body).hexdigest(), "7")
    for size in (1, 7, 1 << 20):  # read in small steps, members split anywhere
        stream = io.BytesIO(both)
        got = list(warc.read_records(lambda n, s=stream, k=size: s.read(min(n, k))))
        assert [r.headers["warc-type"] for r in got] == ["response", "revisit"]
        assert got[1].headers["warc-refers-to"] == warc.record_id("7") and got[0].payload == body


def test_damage_is_found():
    body = b"payload" * 40
    wrong = warc.member("7", "u", body, hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(warc.DigestError):
        list(warc.read_records(io.BytesIO(wrong).read))
    good = warc.member("7", "u", body, hashlib.sha256(body).hexdigest(), None)
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(good[:-20]).read))
    text = gzip.decompress(good).replace(b"Content-Length: 280", b"Content-Length: 281")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(text)).read))
