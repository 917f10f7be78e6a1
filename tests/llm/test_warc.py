import base64
import gzip
import hashlib
import io
import urllib.parse

import pytest

from loanlife.llm import warc as W
from loanlife.llm.queries import op7_warc
from loanlife.session import scratch_path

from .conftest import LONG

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None), (4, "http://a/4", ""),
         (5, "http://a/5\r\nX: y", "é\r\n\r\n<b>" + LONG), (6, "http://b/6", "<p>same</p>"), (6, "http://b/6", "<p>same</p>"),
         (None, "http://c", "<p>only</p>"), (None, "http://d", "<p>same</p>"), (-7, "http://e", "\0\U0001f600")]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first, size = max(ids, default=None), len((html or "").encode())
        revisit = page_id != first and size >= least
        out.append((page_id, size, digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, pages, as_tables):
    assert sorted(map(tuple, op7_warc(spark, as_tables(pages=pages)).collect()), key=str) == brute(PAGES)


def written(spark, frame):
    W.register(spark)
    path = scratch_path(spark, "warc")
    frame.write.format("warc").mode("append").save(path)
    return path


def files(path):
    import pathlib
    return sorted(pathlib.Path(urllib.parse.urlparse(path).path).glob("*.warc.gz"))


def test_payloads_come_back_whole_and_members_are_plain_gzip(spark, pages):
    path = written(spark, W.records(pages))
    rows = spark.read.format("warc").load(path).collect()
    assert sorted(bytes(r["payload"]) for r in rows if r["record_type"] == "response") == sorted(
        (h or "").encode() for (p, _, h) in PAGES for b in [max((q for q, _, g in PAGES if (g or "") == (h or "") and q is not None),
                                                                 default=None)] if p == b)
    for r in rows:
        assert r["payload"] is None or (W.digest_of(bytes(r["payload"])), len(r["payload"])) == (r["payload_digest"], r["payload_length"])
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files(path))
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) and b"WARC-Profile: " + W.REVISIT_PROFILE.encode() in text


def test_predicates_are_pushed_and_payloads_skipped(spark, pages, monkeypatch):
    path = written(spark, W.records(pages))
    got = spark.read.format("warc").load(path).where("record_type = 'revisit' and target_uri like 'http://a%'")
    assert sorted(r["record_id"] for r in got.collect()) == ["urn:page:1", "urn:page:2"]
    reader = W.WarcReader(spark.read.format("warc").load(path).drop("payload").schema, path)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 3)]))
    assert left == [GreaterThan(("payload_length",), 3)] and len(reader.filters) == 1
    decoded = []
    monkeypatch.setattr(W, "READ_BYTES", 64)
    for part in reader.partitions():
        with open(part.path, "rb") as f:
            for headers, block in W.Members(f):
                if headers["warc-type"] == "response" and headers["x-payload-length"] == "0":
                    decoded.append(block())
    assert decoded == [W.HTTP_HEAD] * 1


def test_foreign_members_without_sizes(spark):
    rows = [{"record_type": "response", "record_id": f"urn:page:{i}", "payload": bytes([65 + i]) * (5000 * i + 1)} for i in range(4)]
    stream = io.BytesIO(b"".join(gzip.compress(gzip.decompress(W.record(r))) for r in rows))
    got = [block().partition(b"\r\n\r\n")[2] if i % 2 else None for i, (_, block) in enumerate(W.Members(stream))]
    assert got == [None, rows[1]["payload"], None, rows[3]["payload"]]


def foreign(path, name, *members):
    import pathlib
    file = pathlib.Path(urllib.parse.urlparse(path).path) / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(b"".join(members))


def test_archives_of_another_writer(spark):
    W.register(spark)
    path = scratch_path(spark, "foreign")
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>\r\n\r\nmore"
    info = b"software: crawler\r\n\r\nformat: WARC"

    def member(block, *lines, length=True):
        head = ["WARC/1.0", *lines] + [f"content-length: {len(block)}"] * length
        return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    foreign(path, "a.warc.gz", member(info, "WARC-Type: warcinfo", "WARC-Record-ID: <urn:x:0>", "Content-Type: application/warc-fields"),
            member(http, "warc-type: response", "WARC-RECORD-ID: <urn:x:1>", "Content-Type: application/http; msgtype=response"))
    foreign(path, "deep/b.warc.gz", member(b"plain \r\n\r\n text", "WARC-Type: resource", "WARC-Record-ID: <urn:x:2>", length=False),
            member(b"z" * 3_000_000, "WARC-Type: conversion", "WARC-Record-ID: <urn:x:3>", "X-Payload-Length: many"),
            member(b"", "WARC-Type: metadata", "WARC-Record-ID: <urn:x:4>"))
    foreign(path, "notes.txt", b"no archive")
    got = {r["record_id"]: (r["record_type"], bytes(r["payload"]), r["payload_length"]) for r in spark.read.format("warc").load(path).collect()}
    assert got == {"urn:x:0": ("warcinfo", info, None), "urn:x:1": ("response", b"<p>hi</p>\r\n\r\nmore", None),
                   "urn:x:2": ("resource", b"plain \r\n\r\n text", None), "urn:x:3": ("conversion", b"z" * 3_000_000, None),
                   "urn:x:4": ("metadata", b"", None)}
    assert [r["record_id"] for r in spark.read.format("warc").load(path).where("record_type = 'response'").collect()] == ["urn:x:1"]


@pytest.mark.parametrize("name,data", [("a.txt", b"nothing"), ("a.warc.gz", b"WARC/1.0 as plain text"),
                                       ("a.warc.gz", gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\n" + hashlib.sha512(b"x").digest() * 9)[:-40])])
def test_what_is_no_archive_is_an_error(spark, name, data):
    W.register(spark)
    path = scratch_path(spark, "broken")
    foreign(path, name, data)
    with pytest.raises(Exception, match="neither a manifest|not a gzip member|ends within a record"):
        spark.read.format("warc").load(path).collect()


def test_only_files_of_a_manifest_are_read(spark, pages):
    path = written(spark, W.records(pages))
    stray = files(path)[0].with_name("stray.warc.gz")
    stray.write_bytes(W.record({"record_type": "response", "record_id": "urn:page:99"}))
    assert spark.read.format("warc").load(path).where("record_id = 'urn:page:99'").count() == 0


def test_small_payloads_and_empty_table(spark, pages, as_tables):
    told = W.records(pages, min_bytes=12).collect()
    assert sorted((r["record_id"].rpartition(":")[2], r["record_type"]) for r in told) == sorted(
        ("" if p is None else str(p), t) for p, _, _, t, _ in brute(PAGES, 12))
    empty = spark.createDataFrame([], "page_id bigint, url string, html string, payload string")
    assert op7_warc(spark, as_tables(pages=empty)).collect() == []
