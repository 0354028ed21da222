import gzip
import hashlib
from collections import Counter

import pytest

from daypanel.llm import warc

BIG = "<p>" + "payload " * 200 + "</p>"
TRICKY = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS same", "1 AS h_id")


def round_trip(spark, tmp_path, rows, **how):
    folder = str(tmp_path / "archives")
    warc.write_archives(pages(spark, rows), folder, **how)
    found = warc.assemble(warc.read_records(spark, folder)).collect()
    return {(r.metadata[0].fields["page-id"] or None): r for r in found}, folder


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    rows = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3 \r\nX: y", "small"), (4, None, "small"),
            (5, "http://a/5", None), (6, "http://a/6", TRICKY), (7, "http://a/7", "é漢" * 500), (None, "http://a/n", BIG),
            (9, "http://a/9", ""), (6, "http://a/6", TRICKY), (10, "http://a/10", TRICKY + "é")]
    found, folder = round_trip(spark, tmp_path, rows, records_per_file=3, compression=compression)
    assert set(found) == {str(r[0]) if r[0] else None for r in rows}
    for page_id, url, html in rows:
        capture, payload = found[str(page_id) if page_id else None], (html or "").encode()
        assert capture.payload_bytes == len(payload)
        assert capture.payload_sha1 == hashlib.sha1(payload).hexdigest()
        assert len(capture.requests) == len(capture.metadata) == 1
        revisit = page_id in (1, None)
        assert capture.record_type == ("revisit" if revisit else "response")
        assert capture.refers_to == (found["2"].capture_id if revisit else None)
        assert capture.payload is None if revisit else bytes(capture.payload) == payload
    assert found["3"].target_uri == "http://a/3X:y" and found["4"].target_uri is None


def test_one_capture_per_row(spark, tmp_path, monkeypatch):
    """Rows that repeat, null ids and holders included, are captures of their own."""
    monkeypatch.setattr(warc, "COPIES", 4, raising=False)
    kept = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (2, "http://b/2", BIG), (3, None, "small"), (4, "http://a/4", TRICKY)]
    rows = [*kept, *[(2, "http://a/2", BIG)] * 2, *[(1, "http://a/1", BIG)] * 9, *[(None, None, None)] * 3, *[(3, None, "small")] * 8]
    folder = str(tmp_path / "archives")
    warc.write_archives(pages(spark, rows), folder, records_per_file=3)
    found = warc.assemble(warc.read_records(spark, folder)).collect()
    number = lambda text: int(text) if text else None
    assert Counter((number(r.metadata[0].fields["page-id"]), r.target_uri, r.payload_bytes, r.payload_sha1) for r in found) == Counter(
        (page_id, url, len((html or "").encode()), hashlib.sha1((html or "").encode()).hexdigest()) for page_id, url, html in rows)
    by_id = {r.capture_id: r for r in found}
    assert len(by_id) == len(rows) and all(len(r.requests) == len(r.metadata) == 1 for r in found)
    held = [r for r in found if r.payload_sha1 == hashlib.sha1(BIG.encode()).hexdigest() and r.record_type == "response"]
    assert [(r.metadata[0].fields["page-id"], r.target_uri) for r in held] == [("2", "http://b/2")]
    for r in found:
        revisit = r.payload_sha1 == held[0].payload_sha1 and r.capture_id != held[0].capture_id
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (held[0].capture_id if revisit else None) and (r.payload is None) == revisit


def test_of_pages_that_repeat_one_holds(spark, tmp_path):
    rows = [(5, "http://a/5", BIG)] * 4 + [(6, None, BIG + "x")] * 2 + [(None, "u", BIG + "y")] * 2
    folder = str(tmp_path / "archives")
    warc.write_archives(pages(spark, rows), folder)
    found = warc.assemble(warc.read_records(spark, folder)).collect()
    kinds = Counter((r.metadata[0].fields["page-id"] or None, r.record_type) for r in found)
    assert kinds == {("5", "response"): 1, ("5", "revisit"): 3, ("6", "response"): 1, ("6", "revisit"): 1, (None, "response"): 2}


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, tmp_path, [])[0] == {}


def record(kind, name, block=b"", *headers):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", *headers,
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_assembles_archives_of_others(spark, tmp_path):
    """One member per record, links in either direction and through a request."""
    to = lambda name: b"WARC-Concurrent-To: <" + name + b">"
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    records = [
        record(b"warcinfo", b"info", b"software: x\r\n"),
        record(b"request", b"q1", b"GET / HTTP/1.1\r\n\r\n"), record(b"response", b"r1", http + b"one", to(b"q1")),
        record(b"metadata", b"m1", b"a: 1\r\n", to(b"q1")),
        record(b"response", b"r2", http + b"two"), record(b"request", b"q2", b"GET", to(b"r2")),
        record(b"metadata", b"m2", b"a: 2\r\n", to(b"r2"), to(b"q2")), record(b"metadata", b"m3", b"a: 3\r\n", to(b"r2")),
        record(b"response", b"r3", b"not http"), record(b"request", b"lost", b"GET", to(b"nowhere")),
        record(b"revisit", b"v1", http, b"WARC-Refers-To: <r2>"),
        record(b"revisit", b"v2", http, b"WARC-Refers-To: <gone>", b"WARC-Payload-Digest: sha1:abc")]
    (tmp_path / "part-0.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "part-1.warc").write_bytes(records[4])  # a record that repeats
    found = {r.capture_id: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    ids = lambda parts: sorted(p.record_id for p in parts)
    assert {k: (ids(r.requests), ids(r.metadata)) for k, r in found.items()} == {
        "<r1>": (["<q1>"], ["<m1>"]), "<r2>": (["<q2>"], ["<m2>", "<m3>"]), "<r3>": ([], []), "<v1>": ([], []),
        "<v2>": ([], [])}
    assert bytes(found["<r3>"].payload) == b"not http" and bytes(found["<r1>"].payload) == b"one"
    assert found["<v1>"].payload_sha1 == hashlib.sha1(b"two").hexdigest() and found["<v2>"].payload_sha1 == "abc"


def test_a_cut_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_archive(record(b"response", b"r", b"x" * 50)[:-20]))
