"""WARC derivatives: responses become linked metadata and conversion records.

A response record has an id, a target URI, a date and a block (HTTP header and payload).  For each,

- a ``metadata`` record holds the source's HTTP header fields (as ``http-`` fields), its digests,
  the character set used, the title, the language and the numbers of links and characters;
- a ``conversion`` record holds the page's plain text.

Both carry WARC-Refers-To with the response's id, its target URI and date, a block digest and an id
of their own that is made from the response's id, so that a repeated run gives the same records.
Digests are SHA-1 in base 32, as is common in WARC files.

A null block or payload gives an empty text, a null target URI is left out of the headers.  Bytes
that the character set can't decode become replacement characters.  Repeated responses give
repeated records.  Texts are converted whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read, slices

DATE = "2024-01-01T00:00:00Z"
SLICE_BYTES = 4_000_000
# Fixed values, named by HTML: elements that don't end the head, elements without text for readers,
# elements that end a line, elements that end foreign content they stand in, elements inside
# foreign content that may hold others.
HEAD = {"head", "html", "title", "meta", "link", "base", "script", "style", "template", "noscript",
        "basefont", "bgsound", "noframes"}
SILENT = {"script", "style", "template", "noscript", "head", "svg", "textarea", "select"}
LINES = {"address", "article", "aside", "blockquote", "br", "caption", "dd", "div", "dl", "dt",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"}
BREAKOUT = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em",
            "embed", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "i", "img", "li", "listing",
            "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong",
            "strike", "sub", "sup", "table", "tt", "u", "ul", "var"}
INSIDE = {"foreignobject", "desc", "title"}
SCHEMA = ("warc_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, block_digest string, source_block_digest string, "
          "source_payload_digest string, block string")


class _Reader(HTMLParser):
    """Plain text, title, language and number of links of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.title: list[str] | None = None  # that of the first title outside svg
        self.language, self.links = "", 0
        self.silent: list[str] = []
        self.caption: list[str] | None = None  # of the title that is open
        self.began = False  # the head or, where its tags are left out, the body

    def end_head(self) -> None:
        """What can't stand in the head ends it, for its end tag and the body's tag are optional."""
        self.began = True
        if self.silent == ["head"]:
            self.silent = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if "svg" in self.silent:
            if tag in INSIDE:
                self.silent.append(tag)
                return
            if self.silent[-1] == "svg" and tag in BREAKOUT:  # it was never closed
                while self.silent.pop() != "svg":
                    pass
        if tag not in HEAD:
            self.end_head()
        if tag == "html":
            self.language = dict(attrs).get("lang") or ""
        elif tag == "a" and dict(attrs).get("href"):
            self.links += 1
        elif tag == "body":
            self.silent = []
        elif tag == "title" and "svg" not in self.silent:
            self.caption = []
        if tag == "head":  # a second one, or one in the body, means nothing
            if not self.began:
                self.silent.append(tag)
            self.began = True
        elif tag in SILENT:
            self.silent.append(tag)
        elif tag in LINES:
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag == "title" and self.caption is not None:
            self.end_title()
            return
        if tag in self.silent:
            while self.silent.pop() != tag:
                pass
        elif tag in LINES:
            self.parts.append("\n")

    def end_title(self) -> None:
        if self.title is None:
            self.title = self.caption
        self.caption = None

    def handle_data(self, data: str) -> None:
        if self.caption is not None:
            self.caption.append(data)
            return
        if data.strip():
            self.end_head()
        if not self.silent:
            self.parts.append(data)

    def text(self) -> str:
        if self.caption is not None:
            self.end_title()
        lines = (" ".join(line.split()) for line in "".join(self.parts).split("\n"))
        return "\n".join(line for line in lines if line)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    """A stable id from what identifies the record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def split_http(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields in their order, and the payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return [], block
    fields = []
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.append((name.strip(), value.strip()))
    return fields, payload


def decoded(fields: list[tuple[str, str]], payload: bytes) -> tuple[str, str]:
    """The payload's text and character set: as the header says, else as the page says."""
    content = next((v for n, v in fields if n.lower() == "content-type"), "")
    found = re.search(r"charset=[\"']?([\w.:-]+)", content, re.I) or re.search(
        r"<meta[^>]+charset=[\"']?([\w.:-]+)", payload[:4096].decode("latin-1"), re.I)
    charset = found[1].lower() if found else "utf-8"
    try:
        return payload.decode(charset, "replace"), charset
    except (LookupError, UnicodeError):  # an unknown or unusable character set
        return payload.decode("utf-8", "replace"), "utf-8"


def _derived(source: str, uri: str | None, date: str | None, block: bytes) -> list[dict]:
    fields, payload = split_http(block)
    text, charset = decoded(fields, payload)
    page = _Reader()
    page.feed(text)
    page.close()
    plain = page.text()
    about = {"refers_to": source, "target_uri": uri, "date": date or DATE,
             "source_block_digest": digest(block), "source_payload_digest": digest(payload)}
    clean = " ".join("".join(page.title or ()).split())
    lines = [*[f"http-{n.lower()}: {v}" for n, v in fields],
             f"source-block-digest: {about['source_block_digest']}",
             f"source-payload-digest: {about['source_payload_digest']}",
             f"charset-detected: {charset}", f"title: {clean}", f"language: {page.language}",
             f"links: {page.links}", f"characters: {len(plain)}"]
    described = "".join(f"{line}\r\n" for line in lines)
    return [about | {"warc_type": kind, "record_id": record_id(source, kind), "content_type": mime,
                     "block": body, "block_digest": digest(body.encode())}
            for kind, mime, body in (
                ("metadata", "application/warc-fields", described),
                ("conversion", "text/plain; charset=utf-8", plain))]


def derive(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Two records for each response (record_id, target_uri, date, block) with its kept columns."""
    chosen = responses.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                              "record_id", "target_uri", "date", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "block", SLICE_BYTES):
            source, rows = [], []
            for i, (own, uri, date, block) in enumerate(zip(*(
                    part.column(len(keep) + c).to_pylist() for c in range(4)))):
                for record in _derived(own or "", uri, date, block or b""):
                    source.append(i)
                    rows.append(record)
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(source, pa.int32())) for c in part.columns[:len(keep)]],
                 *[pa.array([r[n] for r in rows], pa.string()) for n in names]],
                [*part.schema.names[:len(keep)], *names])

    schema = "".join(f"k{i} {f.dataType.simpleString()}, "
                     for i, f in enumerate(chosen.schema.fields[:len(keep)]))
    return chosen.mapInArrow(run, schema + SCHEMA).withColumnsRenamed(
        {f"k{i}": c for i, c in enumerate(keep)})


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as response records."""
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"))
    key = F.md5(F.concat_ws(" ", F.lit("response"), F.col("page_id").cast("string"), "url"))
    own = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    return pages.select("page_id", own.alias("record_id"), F.col("url").alias("target_uri"),
                        F.lit(DATE).alias("date"),
                        F.concat(head, body).cast("binary").alias("block"))


def serialised(records: DataFrame) -> DataFrame:
    """Each record as a WARC record without the two line ends that close it."""
    def field(name: str, value: Column) -> Column:
        return F.when(value.isNull(), "").otherwise(
            F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))

    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.col("warc_type")),
        field("WARC-Record-ID", F.col("record_id")), field("WARC-Refers-To", F.col("refers_to")),
        field("WARC-Refers-To-Target-URI", F.col("target_uri")),
        field("WARC-Refers-To-Date", F.col("date")),
        field("WARC-Target-URI", F.col("target_uri")), field("WARC-Date", F.col("date")),
        field("WARC-Block-Digest", F.col("block_digest")),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block")).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of the records; Spark's text writer closes each with the two line ends."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").text(path)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = derive(responses_of_pages(read(spark, folder, "pages", "page_id", "url", "html")),
                     ["page_id"])
    return records.withColumn("content_length", F.octet_length("block").cast("long"))
