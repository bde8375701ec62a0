import gzip

from pyspark.sql import functions as F

from wakeline.llm import warc


def capture(n, url, ts, kind="response", status=200, headers=None, body=None):
    return (n, url, ts, kind, status, headers or {}, None if body is None else body.encode())


def test_revisits(spark):
    rows = [
        capture(1, "http://www.A.com/x/?b=2&a=1&utm_source=q", 100, headers={"etag": '"1"', "content-type": "text/html", "date": "d1"}, body="one"),
        capture(2, "https://a.com/x?a=1&b=2#top", 90_000, headers={"etag": '"2"', "date": "d2"}, body="two"),
        capture(3, "a.com/x?a=1&b=2", 95_000, status=404, body="gone"),
        capture(10, "http://a.com/x?b=2&a=1", 99, "revisit", 304, {"etag": '"1"'}),
        capture(11, "http://a.com/x?b=2&a=1", 100, "revisit", 304, {"etag": '"1"'}),
        capture(12, "http://a.com/x?b=2&a=1", 80_000, "revisit", 304, {"ETag": 'W/"1"', "Date": "d9", "Content-Type": "none"}),
        capture(13, "http://a.com/x?b=2&a=1", 99_000, "revisit", 304, {"etag": '"1"'}),
        capture(14, "http://a.com/x?b=2&a=1", 99_000, "revisit", 304, {}),
        capture(15, None, 5, "revisit", 304, {}),
        capture(16, "http://b.com/", None, "revisit", 304, None),
        capture(12, "http://a.com/x?b=2&a=1", 80_000, "revisit", 304, {"etag": 'W/"1"', "date": "d9", "content-type": "none"}),
    ]
    df = spark.createDataFrame(rows, warc.COLUMNS).withColumn("slot", F.lit("clash"))
    got = warc.resolve_revisits(df).collect()
    by = {r.record_id: r for r in got}
    assert len(got) == 8
    assert {k: (r.outcome, r.source_id) for k, r in by.items()} == {10: ("no_response", None), 11: ("no_response", None), 12: ("resolved", 1), 13: ("mismatch", 2), 14: ("no_validator", 2), 15: ("no_response", None), 16: ("no_response", None)}
    assert by[12].headers == {"etag": 'W/"1"', "date": "d9", "content-type": "text/html"} and by[12].body == b"one"
    assert by[13].headers is None and by[13].body is None
    assert warc.resolve_revisits(df.where("false")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [capture(1, "http://a.com/1", 1704067200, headers={"content-type": "text/html"}, body="<p>hé\r\n\r\nx</p>"), capture(2, "http://a.com/1", 1704070800, "revisit", 304, {"etag": '"1"'})]
    warc.write_warc(spark.createDataFrame(rows, warc.COLUMNS).coalesce(1), str(tmp_path / "w"))
    got = {r.ts: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert got[1704067200].body == "<p>hé\r\n\r\nx</p>".encode() and got[1704067200].status == 200
    assert got[1704067200].headers == {"content-type": "text/html"} and got[1704070800].kind == "revisit" and got[1704070800].url == "http://a.com/1"


HOSTILE = [b"hello WARC/1.0\r\nworld", b"\xff\xfe\x00 not text", b"", b"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc", b"a\r\n\r\nb\r\n\r\n"]


def record(n, body, version="1.0", kind="response"):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: x\r\n\r\n" + body
    head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{n}>\r\nWARC-Target-URI: http://a.com/{n}\r\nWARC-Date: 2024-01-01T00:00:0{n}Z\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def test_content_length_rules(spark, tmp_path):
    """Bodies come back to the byte, from plain and packed files of both versions, whatever they hold."""
    records = [record(n, body, v) for n, (body, v) in enumerate(zip(HOSTILE, ["1.0", "1.1", "1.0", "1.1", "1.0"]))]
    skipped = record(9, b"not wanted", kind="warcinfo")
    (tmp_path / "a.warc").write_bytes(skipped + b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, [*records, skipped])))
    (tmp_path / "c.warc").write_bytes(b"this is no archive")
    (tmp_path / "d.warc").write_bytes(records[0] + records[1][:-20])
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.ts - 1704067200, bytes(r.body)) for r in got) == sorted([*enumerate(HOSTILE)] * 2 + [(0, HOSTILE[0])])
    assert {r.status for r in got} == {200} and all(r.headers == {"content-type": "x"} for r in got)


def test_pages_without_a_number(spark):
    pages = spark.createDataFrame([(1, "http://a.com", "x"), (None, "http://a.com", "y")], "page_id long, url string, html string")
    got = {r.record_id: r.outcome for r in warc.resolve_revisits(warc.page_captures(pages)).collect()}
    assert got == {3: "resolved", None: "no_response"}


def test_headers_alone_are_written_and_read(spark, tmp_path):
    rows = [capture(1, "http://a.com/1", 1704067200, body="no headers"), capture(2, "http://a.com/2", 1704067200, headers={"a": "b"}, body="")]
    warc.write_warc(spark.createDataFrame(rows, warc.COLUMNS), str(tmp_path / "w"))
    assert sorted((r.url[-1], bytes(r.body)) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()) == [("1", b"no headers"), ("2", b"")]


def test_one_header_in_two_cases(spark):
    from wakeline.llm import warc

    rows = [(1, "http://a.org/", 10, "response", 200, {"ETag": "old", "etag": "x"}, "body"), (2, "http://a.org/", 20, "revisit", 304, {"etag": "x", "ETAG": "x"}, None)]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, status int, headers map<string,string>, body string")
    got = warc.resolve_revisits(df).collect()
    assert [(r.source_id, r.outcome) for r in got] == [(1, "resolved")]
