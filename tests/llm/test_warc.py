from __future__ import annotations

import time
import base64
import hashlib
import uuid

from pyspark.sql import functions as F

import pytest

from tenura.llm import warc
from tenura.llm.queries import CRAWL_DATE

RESPONSES = "record_id string, target_uri string, date string, headers map<string,string>, block binary"
PAGE = (
    "<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var t='</p>';</script><!-- gone --><p>One"
    "<b>two</b></p><div>three&nbsp;&lt;four&gt;<br>five</div><a href='/x y'>six</a><A HREF=\"http://o.org/?a=1&amp;b=2\">7</A></body></html>"
)


def block(body, kind="text/html; charset=utf-8", status=200):
    return b"HTTP/1.1 %d OK\r\nContent-Type: %s\r\nX-Own: kept\r\n\r\n" % (status, kind.encode()) + body


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def parsed(record):
    """Header fields and block of a whole record."""
    head, _, body = record.partition("\r\n\r\n")
    lines = head.split("\r\n")
    assert lines[0] == "WARC/1.1"
    return dict(line.split(": ", 1) for line in lines[1:]), body


def test_records_refer_to_their_response(spark):
    held = block(PAGE.encode())
    digests = {"WARC-Block-Digest": "sha1:GIVEN", "WARC-Payload-Digest": "sha1:BODY"}
    df = spark.createDataFrame([("<urn:uuid:1>", "http://a.org/", "2024-05-01T00:00:00Z", digests, held)], RESPONSES)
    rows = {r.warc_type: r for r in warc.build_derivatives(df).collect()}
    assert set(rows) == {"metadata", "conversion"}
    for kind, row in rows.items():
        fields, body = parsed(row.warc)
        assert fields["WARC-Type"] == kind and fields["WARC-Refers-To"] == row.refers_to == "<urn:uuid:1>"
        assert fields["WARC-Target-URI"] == "http://a.org/" and fields["WARC-Date"] == "2024-05-01T00:00:00Z"
        assert body == row.block and int(fields["Content-Length"]) == len(body.encode())
        assert fields["WARC-Block-Digest"] == row.block_digest == sha1(body.encode())
        assert row.source_digest == "sha1:GIVEN" and row.payload_digest == "sha1:BODY"
        assert uuid.UUID(fields["WARC-Record-ID"][10:-1])
    assert rows["conversion"].block == "A & B\nOnetwo\nthree <four>\nfive\nsix7".replace("three ", "three ")
    told = rows["metadata"].block
    for line in ("source-status: 200", "source-charset: utf-8", "source-x-own: kept", "source-payload-digest: sha1:BODY", "outlink: /x y", "outlink: http://o.org/?a=1&b=2"):
        assert f"{line}\r\n" in told


def test_digests_and_character_sets(spark):
    latin = block("café".encode("latin-1"), "text/html; charset=ISO-8859-1")
    odd = block(b"\xff\xfe ok", "text/html; charset=no-such-set", 404)
    rows = [("<urn:uuid:1>", "u", "d", None, latin), ("<urn:uuid:2>", "u", "d", {}, odd)]
    found = {(r.source_id, r.warc_type): r for r in warc.build_derivatives(spark.createDataFrame(rows, RESPONSES)).collect()}
    one = found["<urn:uuid:1>", "conversion"]
    assert one.block == "café" and one.payload_digest == sha1("café".encode("latin-1")) and one.source_digest == sha1(latin)
    assert found["<urn:uuid:2>", "conversion"].block == "�� ok"
    assert "source-status: 404" in found["<urn:uuid:2>", "metadata"].block


def test_odd_responses(spark):
    rows = [
        (None, None, None, None, None), ("<urn:uuid:3>", "http://a\r\nX: y", None, None, b""), ("<urn:uuid:4>", "u", "d", None, b"no http header"),
        ("<urn:uuid:5>", "u", "d", None, block(b"<p>" + b"word " * 200_000)), ("<urn:uuid:5>", "u", "d", None, block(b"again")),
        ("<urn:uuid:5>", "u", "d", None, block(b"again")), ("<urn:uuid:6>", "u", "d", None, b"HTTP/1.1 nonsense\r\nno colon\r\n\r\n<script>never closed"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], RESPONSES + ", warc_type string")
    found = warc.build_derivatives(df).collect()
    assert len(found) == 2 * len(rows)
    for row in found:
        fields, body = parsed(row.warc)
        assert body == row.block and "X" not in fields
    assert len({r.record_id for r in found if r.source_id == "<urn:uuid:5>"}) == 2
    assert warc.build_derivatives(df.limit(0)).count() == 0


def test_pages_become_responses(spark, tmp_path):
    rows = [(1, "http://a.org/", PAGE), (2, None, None), (None, "http://b.org/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    responses = warc.responses_of(pages, CRAWL_DATE)
    assert responses.select("record_id").distinct().count() == 3
    records = warc.build_derivatives(responses)
    assert records.count() == 6
    first = records.where(F.col("target_uri") == "http://a.org/").where("warc_type = 'conversion'").first()
    assert first.payload_digest == sha1(PAGE.encode())
    warc.write_records(records.coalesce(1), str(tmp_path / "out"))
    held = "".join(p.read_bytes().decode() for p in (tmp_path / "out").glob("part-*"))
    wanted = sorted(r.warc for r in records.collect())
    assert held.count("WARC/1.1\r\n") == 6 and all(f"{w}\r\n\r\n" in held for w in wanted)


PIECES = ["<a ", "<a href=", "<", "<title>", "<!--", "</script", "<script>", '<a href="', "< >", "<p", "&lt;", "<a href='x", "</", "<b>x</b>"]


@pytest.mark.parametrize("piece", PIECES)
def test_long_pages_are_read_once(piece):
    """Ten times the page takes about ten times as long, whatever is never closed."""
    times = []
    for n in (20_000, 200_000):
        page, start = piece * n, time.process_time()
        warc.plain_text(page), warc.links(page)
        times.append(time.process_time() - start)
    assert times[1] < 40 * max(times[0], 0.01)


def test_tags_titles_and_links():
    page = (
        "<html><head><title lang=en>A &amp; B</title></head><body><P>one<br>two <b>bold</b> a < b <a href='/x?a=1&amp;b=2'>x</a>"
        '<a class=k HREF="http://y.org/">y</a><a name=z>z</a><abbr href=no>w</abbr><a href=plain>v</a><!-- <a href=gone> --></body> 1 <2'
    )
    assert warc.links(page) == ["/x?a=1&b=2", "http://y.org/", "plain"]
    assert warc.plain_text(page) == "A & B\none\ntwo bold a < b xyzwv 1 <2"
    assert warc.plain_text("<title>never closed <p>text") == "never closed\ntext"
    assert warc.plain_text("x <unclosed tag") == "x <unclosed tag"
