import base64
import hashlib
import time
from html.parser import HTMLParser

from clickloom.llm import warc
from clickloom.llm.warc import derivatives, file_bytes, parse_records, plain_text, responses

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{x}</style><script>var t="</p>";</script></head>
<body><nav><a href="/x?a=1&amp;b=2">x</a></nav><!-- no --><p>one <b>two</b>&nbsp;three<br>four</p><div>5 &lt; 6</div></body></html>"""
ROWS = [(1, "http://a.org/", PAGE), (2, None, None), (3, "http://b\r\n.org/", ""), (None, "x", "no tags"), (5, "y", "<script>open"),
        (1, "http://a.org/", PAGE), (6, "z", "<p>" + "long " * 50000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, block string")


class Shown(HTMLParser):
    """The words of a page by the standard parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.out.append("" if tag in ("b", "a", "i", "span") else " ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.out.append("" if tag in ("b", "a", "i", "span") else " ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_text_of_a_page():
    assert plain_text(PAGE) == "A & B\nx\none two three\nfour\n5 < 6"
    assert plain_text("<script>open") == "" and plain_text("a < b <3") == "a < b <3"


def test_words_agree_with_a_parser(spark, sf_dir):
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(30).collect():
        parser = Shown()
        parser.feed(row.html)
        parser.close()
        assert plain_text(row.html).split() == "".join(parser.out).split()


def test_links_digests_and_round_trip(spark):
    source = responses(pages(spark))
    made = derivatives(source)
    by_id = {r.record_id: r for r in source.collect()}
    rows = made.collect()
    assert len(rows) == 2 * len(ROWS)
    assert {r.warc_type for r in rows} == {"metadata", "conversion"}
    ids = {r.record_id: r for r in rows}
    for r in rows:
        response = by_id[r.refers_to]
        assert (r.target_uri, r.date, r.payload_digest) == (response.target_uri, response.date, response.payload_digest)
        assert ids[r.concurrent_to].refers_to == r.refers_to
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode()
        assert r.content_length == len(r.block)
        if r.warc_type == "metadata":
            assert "source-header: HTTP/1.1 200 OK" in r.block.decode() and r.refers_to in r.block.decode()
    first = next(r for r in rows if r.page_id == 1 and r.warc_type == "metadata").block.decode()
    assert "title: A & B\r\n" in first and "outlink: /x?a=1&b=2\r\n" in first and "language: fr\r\n" in first
    again = [dict(x) for r in file_bytes(made).collect() for x in parse_records(bytes(r.data))]
    key = lambda x: (x["record_id"], x["block"])
    assert sorted(map(key, again)) == sorted((r.record_id, bytes(r.block)) for r in rows)
    whole = b"".join(bytes(r.data) for r in file_bytes(source).collect())
    assert [x["record_id"] for x in parse_records(whole)] == [r.record_id for r in source.collect()]
    assert sorted(r.record_id for r in derivatives(source).collect()) == sorted(r.record_id for r in rows)


def test_empty_table(spark):
    assert derivatives(responses(pages(spark, []))).count() == 0


def test_unclosed_tags_are_read_once():
    for piece in ("<a ", "<a href=", "<a href='", "<p ", "<title ", "<html ", "<!--", "<script ", "</script ", "<html lang "):
        page = piece * 300_000
        started = time.monotonic()
        warc.plain_text(page), warc.TITLE.search(page), warc.language(page), list(warc.outlinks(page))
        assert time.monotonic() - started < 20, piece


def test_links_and_language():
    page = """<html class=x lang='de'><a href="/a>b">1</a><A id=1 HREF = '/c?d=1&amp;e=2'>2</A><a name=n>3</a><a href=/f>4</a><area href=/g>"""
    assert warc.language(page) == "de" and list(warc.outlinks(page)) == ["/a>b", "/c?d=1&e=2", "/f"]
    assert warc.language("<p lang=fr>") is None and warc.plain_text("a <b") == "a"
