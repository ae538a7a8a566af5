import base64
import glob
import gzip
import hashlib
import re

import pytest

from rosterloom.llm import warc

PAGE = ('<!DOCTYPE html><html lang="de"><head><title>A &amp;\n B</title><style>p{}</style></head>'
        '<body><script>var a = "<p>no</p>";</script><h1>Über uns</h1><p>One<br>two <b>three</b>'
        '</p><a href="/x">link</a><ul><li>a<li>b</ul></body></html>')
RESPONSE = ("record_id string, target_uri string, date string, block binary, page_id long, "
            "warc_type string")


def http(body, content="text/html; charset=utf-8"):
    return b"HTTP/1.1 200 OK\r\nContent-Type: " + content.encode() + b"\r\nServer: s\r\n\r\n" + body


def responses(spark, blocks):
    return spark.createDataFrame([(f"<urn:uuid:{i}>", None if i == 1 else f"http://e.org/{i}",
                                   None if i == 2 else "2024-05-05T00:00:00Z", b, i, "clash")
                                  for i, b in enumerate(blocks)], RESPONSE)


BLOCKS = [http(PAGE.encode()), http("é".encode("latin-1"), "text/html; charset=ISO-8859-1"), None,
          b"", b"no http <p>text", http(b"\xff<p>bad", "text/html; charset=unknown-9"),
          http(b"<p>" + b"long " * 300_000), http(b"<p>x", "text/html; charset=hex")]


def test_derivatives(spark):
    rows = warc.derive(responses(spark, BLOCKS), ["page_id"]).collect()
    assert len(rows) == 2 * len(BLOCKS)
    by = {(r["page_id"], r["warc_type"]): r for r in rows}
    text = by[0, "conversion"]
    assert text["block"] == "Über uns\nOne\ntwo three\nlink\na\nb"
    assert text["refers_to"] == "<urn:uuid:0>" and text["target_uri"] == "http://e.org/0"
    sha = base64.b32encode(hashlib.sha1(text["block"].encode()).digest()).decode()
    assert text["block_digest"] == f"sha1:{sha}"
    about = by[0, "metadata"]
    assert about["refers_to"] == "<urn:uuid:0>" and about["record_id"] != text["record_id"]
    fields = dict(line.split(": ", 1) for line in about["block"].split("\r\n") if ": " in line)
    assert (fields["http-server"], fields["title"], fields["language"], fields["links"]) == (
        "s", "A & B", "de", "1")
    payload = base64.b32encode(hashlib.sha1(PAGE.encode()).digest()).decode()
    assert fields["source-payload-digest"] == f"sha1:{payload}"
    assert by[1, "conversion"]["block"] == "é" and by[1, "conversion"]["target_uri"] is None
    assert by[2, "conversion"]["block"] == by[3, "conversion"]["block"] == ""
    assert by[4, "conversion"]["block"] == "no http\ntext"
    assert by[5, "conversion"]["block"] == "�\nbad"
    assert len(by[6, "conversion"]["block"]) == 5 * 300_000 - 1
    assert len({r["record_id"] for r in rows}) == len(rows)


def test_written_files_are_warc_records(spark, tmp_path):
    rows = warc.derive(responses(spark, BLOCKS), ["page_id"])
    warc.write_warc(rows, str(tmp_path / "out"))
    data = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "out" / "*.gz")))
    count = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[size:size + 4] == b"\r\n\r\n"
        data, count = rest[size + 4:], count + 1
    assert count == 2 * len(BLOCKS)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a", "<p>x"), (2, None, None), (1, "http://a", "<p>x")],
                                  "page_id long, url string, html string")
    rows = warc.derive(warc.responses_of_pages(pages), ["page_id"]).collect()
    assert len(rows) == 6 and len({r["record_id"] for r in rows}) == 4
    assert warc.derive(warc.responses_of_pages(pages.limit(0)), ["page_id"]).count() == 0


def test_head_ends_where_its_end_is_left_out(spark):
    pages = {
        "<html><head><title>x</title><p>text<p>more": "text\nmore",
        "<head><title>x</title><meta name=a><link rel=b><style>p{}</style>text": "text",
        "<head><script>a</script><noscript>no</noscript>\n <a href=/x>link</a>": "link",
        "<p>one<head><p>two": "one\ntwo",
        "<head><template><p>no</p></template><title>x</title></head>yes": "yes"}
    rows = warc.derive(responses(spark, [http(p.encode()) for p in pages]), ["page_id"])
    found = {r["page_id"]: r["block"] for r in rows.where("warc_type = 'conversion'").collect()}
    assert [found[i] for i in range(len(pages))] == list(pages.values())


@pytest.mark.parametrize("page, title, text", [
    ("<title>Real</title><svg><title>icon</title><path/></svg><p>a", "Real", "a"),
    ("<svg><title>icon</title></svg><title>Real</title><p>a", "Real", "a"),
    ("<title>one</title><title>two</title><p>a", "one", "a"),
    ("<p>a<svg><path><p>b<p>c", "", "a\nb\nc"),
    ("<p>a<svg><foreignObject><p>in</p></foreignObject><text>t</text></svg>b<p>c", "", "a\nb\nc"),
    ("<p>a<svg><g><desc><b>x</b></desc></g><path><div>d</div>", "", "a\nd"),
    ("<title>never closed", "never closed", "")])
def test_titles_and_foreign_content(page, title, text):
    reader = warc._Reader()
    reader.feed(page)
    reader.close()
    assert (reader.text(), "".join(reader.title or ())) == (text, title)
