import base64
import hashlib
import html.parser

import pytest

from shelfwise.llm import warc

PAGE = (
    '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{x}</style></head><body><script>var t="</p>";</script>'
    '<!-- note --><p>First <b>bold</b> &lt;line&gt;</p><p>Second&nbsp;line</p><a href="/one?a=1&amp;b=2">one</a><a href="/one?a=1&amp;b=2">again</a></body></html>'
)
ODD = [
    (1, "http://a.example/x y", PAGE), (2, None, None), (3, "http://b.example/", ""), (4, "http://b.example/", "plain, no tags"), (4, "http://b.example/", "plain, no tags"),
    (None, "http://c.example/", "<p>lost"), (5, "u", "<p>" * 20_000 + "deep" + "<"), (6, "u\r\nX: y", "line\r\n\r\nline"), (7, "é", "日本語 é 😀"),
]


class Text(html.parser.HTMLParser):
    """Visible words of a page by the standard parser."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.selectExpr("*", "'x' AS record", "'y' AS id", "'z' AS record_type")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_of_a_page():
    response = warc.response_record("http://a.example/", PAGE, "1")
    source, block = warc.parse_record(response)
    assert source["warc-block-digest"] == sha1(block) and source["warc-payload-digest"] == sha1(PAGE.encode())
    (m, m_id, m_to, meta), (c, c_id, c_to, conversion) = warc.derive(response)
    assert (m, c) == ("metadata", "conversion") and m_to == c_to == source["warc-record-id"] and len({m_id, c_id, m_to}) == 3
    for record in (meta, conversion):
        headers, body = warc.parse_record(record)
        assert headers["warc-refers-to"] == source["warc-record-id"]
        for name in ("warc-target-uri", "warc-date", "warc-payload-digest"):
            assert headers[name] == source[name]
        assert headers["warc-block-digest"] == sha1(body) and int(headers["content-length"]) == len(body)
    assert warc.parse_record(conversion)[1].decode() == "First bold <line>\nSecond line\noneagain"
    fields = warc.parse_record(meta)[1].decode().splitlines()
    assert fields == [
        "fetch-status: HTTP/1.1 200 OK", "http-content-type: text/html; charset=UTF-8", f"http-content-length: {len(PAGE.encode())}",
        "title: A & B", "language: fr", "outlink: /one?a=1&b=2",
    ]
    assert warc.derive(response) == warc.derive(response) and warc.derive(meta) == []


def test_source_headers_and_charsets_are_kept():
    block = b"HTTP/1.1 404 Not Found\r\nServer: x\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9</p>"
    record = warc.make_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "u"), ("WARC-Date", "d")], block)
    meta, conversion = (warc.parse_record(r[3])[1].decode() for r in warc.derive(record))
    assert "fetch-status: HTTP/1.1 404 Not Found" in meta and "http-server: x" in meta and conversion == "café"
    assert warc.parse_record(warc.derive(record)[0][3])[0]["warc-payload-digest"] == sha1(b"<p>caf\xe9</p>")


def test_repeated_headers_are_kept():
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nLink: <x>\r\nset-cookie: b=2\r\nContent-Type: text/html\r\nLink: <y>\r\n\r\nx"
    record = warc.make_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>")], block)
    fields = warc.parse_record(warc.derive(record, "12")[0][3])
    assert fields[0]["warc-source-key"] == "12"
    assert [x for x in fields[1].decode().splitlines() if x.startswith("http-")] == [
        "http-set-cookie: a=1", "http-link: <x>", "http-set-cookie: b=2", "http-content-type: text/html", "http-link: <y>",
    ]


def test_broken_blocks_are_noticed(spark):
    good = warc.derive(warc.response_record("u", "<p>text", "1"), "1")[1][3]
    rows = [(good,), (good.replace(b"text", b"tent", 2),), (good[:-1],), (None,)]
    got = [r["intact"] for r in warc.describe(spark.createDataFrame(rows, "record binary").coalesce(1)).collect()]
    assert got == [True, False, False]


def test_text_of_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60).collect()
    for r in rows:
        parser = Text()
        parser.feed(r["html"])
        assert "".join(warc.plain_text(r["html"]).split()) == "".join("".join(parser.words).split())


def test_odd_rows(spark):
    got = warc.derivative_files(pages(spark, ODD)).collect()
    assert len(got) == 2 * len(ODD) and all(r["intact"] for r in got)
    straight = warc.describe(warc.derivatives(warc.responses(pages(spark, ODD)))).collect()
    assert sorted(got, key=str) == sorted(straight, key=str)
    assert warc.derivative_files(pages(spark, [])).collect() == []
    for i, url, body in ODD:
        mine = [r for r in got if r["page_id"] == i]
        assert {r["payload_digest"] for r in mine} == {sha1((body or "").encode())}
        assert {r["record_type"] for r in mine} == {"metadata", "conversion"}
        assert all(len({x["record_id"] for x in mine if x["record_type"] == k}) == 1 for k in ("metadata", "conversion"))
    assert "deep" in warc.plain_text(ODD[6][2])


@pytest.mark.parametrize("rows", [ODD, []])
def test_files(spark, tmp_path, rows):
    derived = warc.derivatives(warc.responses(pages(spark, rows)))
    path = f"file://{tmp_path}/warc"
    warc.write_warc(derived, path)
    want = sorted(bytes(r["record"]) for r in derived.collect())
    assert sorted(bytes(r["record"]) for r in warc.read_warc(spark, path).collect()) == want


def test_other_records_give_none(spark):
    df = spark.createDataFrame([(1, b"no record"), (2, None), (3, b"WARC/1.1\r\nWARC-Type: request\r\n\r\nx")], "page_id bigint, record binary")
    assert warc.derivatives(df).collect() == []
