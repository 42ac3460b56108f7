"""Archives against plain Python readings of them, and captures of hand-made records."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib

import pytest

from plumbline.llm import warc
from plumbline.llm.stored import Stored

PAGES = "page_id long, url string, html string, record string, `a.b` int"


def expected(pages, least=0):
    first = {}
    for i, (page, _, html, *_) in enumerate(pages):
        key = (page is None, page or 0, i)
        if html not in first or key < first[html][0]:
            first[html] = (key, page)
    found = []
    for i, (page, _, html, *_) in enumerate(pages):
        raw = (html or "").encode()
        again = len(raw) >= least and first[html][0][2] != i
        found.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response",
                      first[html][1] if again else None))
    return sorted(found, key=str)


def test_round_trip_of_odd_pages(spark):
    long = "<p>é€😀\r\n\r\nWARC/1.1\r\n</p>" * 60_000
    pages = [(5, "http://a.de/x?y#z", "<b>1</b>", "r", 1), (3, "http://b.de", "<b>1</b>", "r", 1), (3, "http://b.de", "<b>1</b>", "r", 1), (None, None, "<b>1</b>", None, None),
             (9, "no scheme\r\nWARC-Type: resource", "", "r", 1), (10, "", "", "r", 1), (11, "http://ü.de/ä", long, "r", 1), (-4, "ftp://x", long, "r", 1), (12, "u", "\r\n\r\n", "r", 1),
             (None, "u", "once", "r", 1)]
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for least in (0, 5):
        rows = warc.round_trip(df, least_bytes=least).collect()
        assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == expected(pages, least)
        assert all(r.n_requests == 1 for r in rows)
    assert warc.round_trip(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(7, None, None, "r", 1), (8, "u", "", "r", 1)], PAGES)
    assert sorted(tuple(r[c] for c in ("page_id", "payload_bytes", "refers_to")) for r in warc.round_trip(nulls).collect()) == [(7, 0, None), (8, 0, 7)]


def test_archives_keep_what_any_reader_needs(spark, tmp_path):
    pages = [(1, "http://a.de/x", "<i>é</i>"), (2, "http://a.de/y", "<i>é</i>"), (3, None, None)]
    stored = Stored(spark)
    path = f"{tmp_path}/archive"
    warc.write(warc.records(spark.createDataFrame(pages, "page_id long, url string, html string"), stored), path, file_records=4)
    files = glob.glob(f"{path}/*.gz")
    kinds = []
    for file in files:
        data, at = gzip.open(file).read(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            at = end + 4 + int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and data[at : at + 4] == b"\r\n\r\n" and {"WARC-Record-ID", "WARC-Date", "WARC-Type"} <= set(fields)
            assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit") and ("WARC-Target-URI" in fields) == ("page-id: 3" not in data[end:at].decode() and fields.get("WARC-Target-URI") is not None)
            kinds.append(fields["WARC-Type"])
            at += 4
    assert sorted(kinds) == ["metadata"] * 3 + ["request"] * 3 + ["response"] * 2 + ["revisit"]
    nested = {r.metadata[0].payload.decode().split("\r\n")[0]: r for r in warc.captures(warc.read(spark, path), stored).collect()}
    one = nested["page-id: 1"]
    assert one.response.payload.decode() == "<i>é</i>" and one.response.http_headers["content-type"].startswith("text/html")
    assert one.requests[0].payload == b"" and one.response.target_uri == "http://a.de/x" and nested["page-id: 2"].response.refers_to == one.capture_id
    assert nested["page-id: 2"].response.payload is None and nested["page-id: 3"].response.target_uri is None


def test_transactions_tied_in_other_ways(spark, tmp_path):
    def record(kind, own, body="", **more):
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own), *((k.replace("_", "-"), v) for k, vs in more.items() for v in (vs if isinstance(vs, list) else [vs]))]
        return "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"

    text = [record("warcinfo", "<i>"), record("response", "<r1>", "abc", WARC_Concurrent_To=["<q1>", "<q2>"]), record("request", "<q1>"), record("request", "<q2>"),
            record("metadata", "<m1>", WARC_Concurrent_To="<q1>"), record("metadata", "<m2>", WARC_Concurrent_To="<gone>"), record("request", "<q3>", WARC_Concurrent_To="<gone>"),
            record("response", "<r2>", WARC_Date="2"), record("response", "<r2>", WARC_Date="1", body="xy"), record("request", "<q4>")]
    members = [gzip.compress(t.encode()) for t in text]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members[:5]))
    (tmp_path / "b.warc").write_bytes("".join(text[5:]).encode())
    rows = {r.capture_id: r for r in warc.captures(warc.read(spark, str(tmp_path)), Stored(spark)).collect()}
    ids = lambda xs: [x.record_id for x in xs or []]
    assert {k: (r.response and r.response.payload, ids(r.requests), ids(r.metadata)) for k, r in rows.items()} == {
        "<r1>": (b"abc", ["<q1>", "<q2>"], ["<m1>"]), "<gone>": (None, ["<q3>"], ["<m2>"]), "<r2>": (b"xy", [], []), "<q4>": (None, ["<q4>"], [])}


def test_broken_archives_are_errors(spark, tmp_path):
    for name, data in (("cut", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc"), ("odd", b"HELLO\r\n\r\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(data)
        with pytest.raises(Exception, match="record"):
            warc.read(spark, str(tmp_path / name)).collect()
