"""Derivatives of WARC responses (operator 1).

From every response record come two linked records: ``metadata`` (a block of
``application/warc-fields``) and ``conversion`` (the page as plain text).  Both
name the response in ``WARC-Refers-To`` and keep its target URI and date; the
metadata block keeps the response's HTTP status and headers, its digests, whether they
still hold, the title and the number of links, and names the conversion.

Record ids are derived from the response's id and the record's kind, so a job
that runs again after a lost executor makes the same ones.  ``write_warc``
writes records of any kind as WARC/1.1 files with Spark's text writer: a record
is its header, an empty line and its block, and the separator of lines is the
two line ends that close a record.

Defined results: a null url or page is empty; a block without an empty line has
no HTTP headers and is all payload; a null digest is not checked (``digest_ok``
is null); null and repeated ids: two records for each row; an empty table gives
an empty result.  Work is in proportion to a page's length, also for pages of
tags that are never closed.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import common as C

#: Date of records made from pages, which have none.
PAGE_DATE = "2024-01-01T00:00:00Z"
EOL = "\r\n"

# Elements without text of their own, and those that end a line.
_SILENT = [re.compile(rf"<{t}\b.*?(?:</{t}\s*>|\Z)", re.I | re.S) for t in ("script", "style", "noscript", "template")]
_BREAKS = re.compile(r"</?(?:p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|article|section|header|footer|nav|title|blockquote|pre|form|hr|main|aside)\b[^>]*(?:>|\Z)", re.I)
_COMMENT, _TAG = re.compile(r"<!--.*?(?:-->|\Z)", re.S), re.compile(r"<[a-zA-Z/!?][^>]*(?:>|\Z)")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
_ANCHOR, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=", re.I)
_BLANK, _LINES = re.compile(r"[ \t\r\f\v ]+"), re.compile(r" ?\n[ \n]*")


def _tidy(text: str) -> str:
    return _LINES.sub("\n", _BLANK.sub(" ", html.unescape(text))).strip(" \n")


def plain_text(page: str) -> str:
    """The text of an HTML page, a line for each block."""
    page = _COMMENT.sub(" ", page)
    for silent in _SILENT:
        page = silent.sub(" ", page)
    return _tidy(_TAG.sub("", _BREAKS.sub("\n", page)))


def title_of(page: str) -> str:
    """The text of the first title element (empty if it is not closed)."""
    begin = _TITLE.search(page)
    at = page.find(">", begin.end()) + 1 if begin else 0
    end = _TITLE_END.search(page, at) if at else None
    return _tidy(_TAG.sub("", page[at:end.start()])).replace("\n", " ") if end else ""


def links_of(page: str) -> int:
    """Anchors with an address; each tag is looked at once, up to its end."""
    n = at = 0
    while found := _ANCHOR.search(page, at):
        at = page.find(">", found.end())
        at = at if at >= 0 else len(page)
        n += _HREF.search(page, found.end(), at) is not None
    return n


def digest(block: bytes) -> str:
    return "sha256:" + hashlib.sha256(block).hexdigest()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5('|'.join(parts).encode(), usedforsecurity=False).hexdigest())}>"


def responses_of(pages: DataFrame, date: str = PAGE_DATE) -> DataFrame:
    """Response records of crawled pages: ``page_id, record_id, target_uri, date,
    block`` (the HTTP message), ``block_digest, payload_digest``."""
    page, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.coalesce(F.col("url").cast("string"), F.lit(""))
    page_id = F.col("page_id").cast("bigint")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.octet_length("page").cast("string"), F.lit(EOL * 2))
    rows = pages.select(page_id.alias("page_id"), url.alias("target_uri"), page.alias("page"))
    rows = rows.withColumn("block", F.concat(head, "page"))
    key = F.md5(F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "page"))
    dashed = F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    sha = lambda c: F.concat(F.lit("sha256:"), F.sha2(F.col(c).cast("binary"), 256))
    return rows.select("page_id", F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), "target_uri", F.lit(date).alias("date"),
                       F.col("block").cast("binary").alias("block"), sha("block").alias("block_digest"), sha("page").alias("payload_digest"))


_RECORD = pa.schema([("page_id", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                     ("date", pa.string()), ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()),
                     ("source_payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("block", pa.string())])
RECORD = ("page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, content_length bigint, "
          "block_digest string, source_payload_digest string, digest_ok boolean, block string")


def _derive(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            block, source = r["block"] or b"", r["record_id"] or ""
            head, gap, payload = block.partition(b"\r\n\r\n")
            if not gap:
                head, payload = b"", block
            known = [(r["block_digest"], block), (r["payload_digest"], payload)]
            ok = all(d == digest(b) for d, b in known if d) if any(d for d, _ in known) else None
            page = payload.decode(errors="replace")
            text = plain_text(page)
            conversion, metadata = record_id("conversion", source), record_id("metadata", source)
            status, *headers = head.decode(errors="replace").split(EOL)
            fields = [("conversion", conversion), ("source-block-digest", r["block_digest"] or ""), ("source-payload-digest", r["payload_digest"] or ""),
                      ("http-status", status)] + [("http-header", h) for h in headers] + [("title", title_of(page)), ("links", str(links_of(page)))]
            for kind, own, mime, body in (("metadata", metadata, "application/warc-fields", "".join(f"{k}: {v}{EOL}" for k, v in fields)),
                                          ("conversion", conversion, "text/plain; charset=utf-8", text)):
                raw = body.encode()
                out.append((r["page_id"], kind, own, source, r["target_uri"], r["date"], mime, len(raw), digest(raw), r["payload_digest"], ok, body))
            if len(out) >= 2000:
                yield C.table(_RECORD, *zip(*out))
                out = []
        if out:
            yield C.table(_RECORD, *zip(*out))


def derivatives(responses: DataFrame) -> DataFrame:
    """The two derived records of each response (columns as in ``responses_of``)."""
    return responses.select("page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest").mapInArrow(_derive, RECORD)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC/1.1 files, one for each partition."""
    line = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(EOL))).otherwise("")
    head = F.concat(F.lit(f"WARC/1.1{EOL}"), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
                    line("WARC-Target-URI", "target_uri"), line("WARC-Date", "date"), line("WARC-Block-Digest", "block_digest"),
                    line("Content-Type", "content_type"), line("Content-Length", "content_length"), F.lit(EOL))
    records.select(F.concat(head, "block").alias("value")).write.option("lineSep", EOL * 2).option("compression", compression).text(path)


def op1_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    return derivatives(responses_of(C.read(spark, sf_dir, "pages")))
