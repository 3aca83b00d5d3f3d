"""Archives: written, normalised, read alone at each offset."""

import gzip
import json
import zlib
from pathlib import Path

import pytest

from ledgerloom.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def test_round_trip(spark, tmp_path):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, None, "same"), (3, None, "same"), (4, "u 4\n", big), (5, "u5", None), (6, "u6", ""), (None, "u7", "same"), (None, "u8", "alone")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(2)
    files = warc.write_archives(pages, f"{tmp_path}/whole", file_bytes=1 << 18)
    for path in Path(tmp_path, "whole").iterdir():
        inflate = zlib.decompressobj(31)
        inflate.decompress(path.read_bytes())
        assert inflate.eof and not inflate.unused_data  # one member
    members = warc.normalise(files, f"{tmp_path}/members")
    for row in members.collect():
        data = Path(row.file).read_bytes()
        entries = [json.loads(x) for x in Path(row["index"]).read_text().splitlines()]
        assert len(entries) == row.records and sum(e["length"] for e in entries) == len(data)
        for e in entries:
            header, _, _ = warc.parse_record(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]))
            assert (header["warc-record-id"], header["warc-type"], warc.target_url(header)) == (e["id"], e["type"], e["url"])
    found = sorted((r.record_id, r.url, r.record_type, r.payload_bytes, r.refers_to, bytes(r.payload or b"").decode()) for r in warc.read_archives(members).select("*").collect() if r.url is not None)
    assert found == [
        ("1", "u1", "revisit", 4, "3", ""), ("2", "u2", "revisit", 4, "3", ""), ("4", "u 4\n", "response", len(big.encode()), None, big),
        ("5", "u5", "revisit", 0, "6", ""), ("6", "u6", "response", 0, None, ""), ("None", "u7", "revisit", 4, "3", ""), ("None", "u8", "response", 5, None, "alone"),
    ]
    assert [(r.record_id, r.record_type, r.payload_digest) for r in warc.read_archives(members).where("url IS NULL").collect()] == [("3", "response", warc.base32_sha1(b"same"))] * 2


def test_small_payloads_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "x", ""), (2, "b", "x", "")], SCHEMA)
    files = warc.write_archives(pages, f"{tmp_path}/w", revisit_min_bytes=2)
    assert {r.record_type for r in warc.read_archives(warc.normalise(files, f"{tmp_path}/m")).collect()} == {"response"}
    none = warc.write_archives(pages.where("false"), f"{tmp_path}/w2")
    assert warc.read_archives(warc.normalise(none, f"{tmp_path}/m2")).count() == 0


def test_any_members_inflate():
    records = [warc.record_bytes("response", i, "u", warc.base32_sha1(b"p" * i), i, b"p" * i) for i in range(1, 60)]
    whole = b"".join(records)
    streams = [gzip.compress(whole), b"".join(map(gzip.compress, records)), gzip.compress(whole[:700]) + gzip.compress(whole[700:])]
    for stream in streams:
        for step in (1, 7, 4096):
            assert list(warc.inflated_records(stream[i : i + step] for i in range(0, len(stream), step))) == records
    with pytest.raises(ValueError):
        list(warc.inflated_records([gzip.compress(whole[:-5])]))


HTTP = b"HTTP/1.1 200 OK\r\ncontent-length: 5\r\n\r\n"
FOREIGN = [
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: 16\r\n\r\nsoftware: x/1\r\n\n",
    b"WARC/1.0\r\nwarc-type: request\r\nwarc-record-id:<urn:uuid:2>\r\nwarc-target-uri: http://a.b/c?d=\"e\"\r\ncontent-length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n",
    b"WARC/1.0\r\nWARC-TYPE: response\r\nWARC-Record-ID: <urn:uuid:3>\r\nWARC-Target-URI: <http://a.b/c>\r\nContent-Length:%d\r\n\r\n" % (len(HTTP) + 5) + HTTP + b"hello",
    b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:4>\r\nX-Folded: one\r\n two\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 9\r\n\r\n\r\n\r\nWARC/" % warc.base32_sha1(b"\r\n\r\nWARC/").encode(),
    b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:5>\r\nWARC-Refers-To: <urn:uuid:3>\r\nWARC-Target-URI: http://a.b/\xc3\xa9\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 0\r\n\r\n",
    b"WARC/1.0\r\nContent-Length: 4\r\n\r\n\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 3\r\n\r\nbad" % (b"A" * 32),
]
READ = [
    ("urn:uuid:1", None, "warcinfo", 16, None, b"software: x/1\r\n\n", None),
    ("urn:uuid:2", 'http://a.b/c?d="e"', "request", 18, None, b"GET / HTTP/1.1\r\n\r\n", None),
    ("urn:uuid:3", "http://a.b/c", "response", 5, None, b"hello", None),
    ("urn:uuid:4", None, "resource", 9, None, b"\r\n\r\nWARC/", True),
    ("urn:uuid:5", "http://a.b/é", "revisit", None, "urn:uuid:3", None, None),
    (None, None, None, 4, None, b"\r\n\r\n", None),
    (None, None, "response", 3, None, b"bad", False),
]


def test_archives_of_other_writers(spark, tmp_path):
    """One member, a member per record, several records per member, padding, no compression, no closing lines."""
    closed = [x + b"\r\n\r\n" for x in FOREIGN]
    whole = b"".join(closed)
    forms = {
        "one": gzip.compress(whole),
        "each": b"".join(map(gzip.compress, closed)),
        "some": gzip.compress(whole[:500]) + b"\0" * 300 + gzip.compress(whole[500:]),
        "plain": whole,
        "open": gzip.compress(whole.rstrip(b"\r\n")),
        "gaps": gzip.compress(b"\r\n" + b"\r\n\r\n".join(closed)),
    }
    for name, data in forms.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / f"{name}.warc.gz"),) for name in forms], "file string")
    members = warc.normalise(files, f"{tmp_path}/members")
    assert {r.records for r in members.collect()} == {len(FOREIGN)}
    for row in members.collect():
        data = Path(row.file).read_bytes()
        entries = [json.loads(x) for x in Path(row["index"]).read_text().splitlines()]
        alone = [gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) for e in entries]
        assert alone == closed  # byte for byte
        assert [e["url"] for e in entries] == [r[1] for r in READ]
        got = [tuple(r) for r in warc.read_archives(members.where(members.file == row.file)).select("record_id", "url", "record_type", "payload_bytes", "refers_to", "payload", "intact").collect()]
        assert [(*r[:5], None if r[5] is None else bytes(r[5]), r[6]) for r in got] == READ


@pytest.mark.parametrize("broken", [b"HTTP/1.1 200\r\nContent-Length: 1\r\n\r\nx", b"WARC/1.0\r\nWARC-Type: x\r\n\r\nabc\r\n\r\n", b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc"])
def test_what_is_no_record_is_an_error(broken):
    with pytest.raises(ValueError):
        for data in warc.inflated_records(iter([gzip.compress(broken)])):
            warc.parse_record(data)


def test_many_files_share_tasks(spark):
    files = spark.range(1000)
    assert warc._spread(files) == 125 and warc._spread(files.limit(3)) == 3 and warc._spread(files.limit(0)) == 1
