"""Derivatives of web responses: linked metadata and plain-text conversion records."""

from __future__ import annotations

import base64
import bisect
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.llm.common import arrow_pass, query, table

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
LINE = "\r\n"
RECORD_END = LINE + LINE

# Elements whose text is not shown, and elements that start a new line.
HIDDEN = re.compile(rb"<!--|<(script|style)(?=[\s/>])|<(/?)(noscript|template|svg)(?=[\s/>])[^<>]*>", re.I)
ENDS = re.compile(rb"-->|</(script|style|noscript|template|svg)(?=[\s/>])[^<>]*>", re.I)
BREAKS = re.compile(rb"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|body|head|html|blockquote|pre|hr)\b[^<>]*>", re.I)
TAG = re.compile(rb"<[a-zA-Z/!?][^<>]*>")
TITLE = re.compile(rb"<title\b[^<>]*>([^<]*)", re.I)
LINK = re.compile(rb"""<a\s[^<>]*?href\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)'|([^\s"'<>]+))""", re.I)

SCHEMA = ("key string, record_id string, warc_type string, refers_to string, target_uri string, warc_date string, "
          "content_type string, content string, content_length bigint, block_digest string, source_digest string, "
          "source_headers string, record string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def shown(page: bytes) -> bytes:
    """A page with a space for each comment and element that is not shown.

    A comment, script or style that is left open runs to the end of the page; of another hidden element left open, or a
    closing tag alone, only the tag goes. An <svg .../> ends itself. Inside an element that is closed later, what is left
    open before that end does not reach beyond it.
    """
    ends: dict[bytes, list[tuple[int, int]]] = {}
    for m in ENDS.finditer(page):
        ends.setdefault((m[1] or b"-->").lower(), []).append(m.span())

    def following(name: bytes, at: int) -> tuple[int, int] | None:
        own = ends.get(name, [])
        i = bisect.bisect_left(own, (at, 0))
        return own[i] if i < len(own) else None
    gone: list[tuple[int, int]] = []
    opened: dict[bytes, list[int]] = {b"noscript": [], b"template": [], b"svg": []}
    at = 0
    while m := HIDDEN.search(page, at):
        at = m.end()
        if m[3] is None:
            end = following((m[1] or b"-->").lower(), at)
            around = min((e for name, starts in opened.items() if starts and (e := following(name, at))), default=None)
            if around is None or (end is not None and end[0] < around[0]):
                at = len(page) if end is None else end[1]
                gone.append((m.start(), at))
            continue
        gone.append(m.span())
        name = m[3].lower()
        if not m[2] and not (name == b"svg" and m[0].endswith(b"/>")):
            opened[name].append(m.start())
        elif m[2] and opened[name]:
            gone.append((start := opened[name].pop(), at))
            for starts in opened.values():      # what is left open inside ends here
                while starts and starts[-1] > start:
                    starts.pop()
    out, at = [], 0
    for start, end in sorted(gone):
        if end > at:
            out.append(page[at:max(at, start)])
            at = end
    return b" ".join([*out, page[at:]])


def plain_text(page: bytes) -> str:
    """The shown text of a page, a line per block; each pattern reads the page once, also where tags are left open."""
    text = TAG.sub(b"", BREAKS.sub(b"\n", shown(page)))
    lines = (" ".join(line.split()) for line in html.unescape(text.decode("utf-8", "replace")).split("\n"))
    return "\n".join(line for line in lines if line)


def facts(page: bytes) -> dict:
    """Title and links of a page."""
    page = shown(page)
    words = lambda raw: " ".join(html.unescape(raw.decode("utf-8", "replace")).split())
    title = TITLE.search(page)
    return {"title": words(title[1]) if title else None,
            "links": [words(next(g for g in m.groups() if g is not None)) for m in LINK.finditer(page)]}


def frame(headers: list[tuple[str, str | None]], content: bytes) -> str:
    """A record without its closing empty lines; line breaks in header values become spaces."""
    told = [f"{name}: {' '.join(value.split())}" for name, value in headers if value is not None]
    return LINE.join([VERSION, *told, f"Content-Length: {len(content)}", "", content.decode("utf-8")])


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Response records (key, record_id, target_uri, warc_date, headers, payload) of a table of pages.

    The id follows from key, url and payload, so a repeated run gives the same. A null page counts as empty; a null url
    leaves the record without target. Rows that repeat key, url and page give records of the same id.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    raw = F.md5(F.concat_ws("\x00", F.col(key).cast("string"), F.col(url), F.sha1(payload)).cast("binary"))
    part = lambda at, n: F.substring(raw, at, n)
    number = F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("4"), part(14, 3)), F.concat(F.lit("8"), part(18, 3)), part(21, 12))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(key).cast("string").alias("key"), F.concat(F.lit("<urn:uuid:"), number, F.lit(">")).alias("record_id"),
                        F.col(url).alias("target_uri"), F.lit(DATE).alias("warc_date"), headers.alias("headers"), payload.alias("payload"))


def _derive(batch: pa.RecordBatch) -> dict:
    out = {name.split()[0]: [] for name in SCHEMA.split(", ")}
    for key, source, target, date, headers, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        headers, payload = headers or "", payload or b""
        sum_ = digest(payload)
        told = {"Envelope": {"Payload-Digest": sum_, "Payload-Length": len(payload), "HTTP-Headers": headers.rstrip("\r\n").split("\r\n"),
                             "HTML": facts(payload)}}
        for kind, content_type, content in (("metadata", "application/json", json.dumps(told, ensure_ascii=False, sort_keys=True)),
                                            ("conversion", "text/plain", plain_text(payload))):
            data = content.encode("utf-8", "replace")
            id_ = identifier(kind, source, sum_)
            block = digest(data)
            record = frame([("WARC-Type", kind), ("WARC-Record-ID", id_), ("WARC-Date", date), ("WARC-Refers-To", source),
                            ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", target),
                            ("WARC-Block-Digest", block), ("WARC-Source-Payload-Digest", sum_),
                            ("WARC-Source-HTTP-Headers", base64.b64encode(headers.encode()).decode()), ("Content-Type", content_type)], data)
            for name, value in zip(out, (key, id_, kind, source, target, date, content_type, data.decode(), len(data), block, sum_, headers, record), strict=True):
                out[name].append(value)
    return out


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response (see ``responses`` for the columns), no shuffle.

    Both refer to the response by id, target and date, and carry its HTTP headers and payload digest. ``record`` is the framed
    record. An empty payload gives an empty conversion; bytes that are no UTF-8 become replacement characters. Repeated
    responses give repeated records, an empty table none; other columns are not looked at.
    """
    return arrow_pass(records.select("key", "record_id", "target_uri", "warc_date", "headers", "payload"), SCHEMA, _derive)


def write(derived: DataFrame, folder: str, records_per_file: int = 100_000) -> None:
    """Write framed records as plain archive files; the line separator of Spark's text writer closes each record."""
    derived.select("record").write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records_per_file).text(folder)


def _split(data: bytes) -> list[dict]:
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(LINE)
        if lines[0] != VERSION:
            raise ValueError(f"no record starts at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        out.append({"headers": headers, "content": data[end + 4:end + 4 + size]})
        at = end + 4 + size + len(RECORD_END)
    return out


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records (headers map, content bytes) of a folder of plain archive files, found by their content length."""
    def parsed(batch: pa.RecordBatch) -> dict:
        found = [r for data in batch.column(0).to_pylist() for r in _split(data)]
        return {"headers": [list(r["headers"].items()) for r in found], "content": [r["content"] for r in found]}
    files = spark.read.format("binaryFile").load(folder).select("content")
    return arrow_pass(files, "headers map<string,string>, content binary", parsed)


@query("op3_warc_derivatives")
def op3_warc_derivatives(spark, d):
    return derive(responses(table(spark, d, "pages"))).withColumnRenamed("key", "page_id").withColumn("page_id", F.col("page_id").cast("long"))
