"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagemart.llm.markup import read_page
from stagemart.llm.shipping import session_of

VERSION = "WARC/1.1"
_END = "\r\n\r\n"
RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string,"
    " payload_digest string, block_digest string, content_length long, record string"
)
_NAMES = [part.split()[0] for part in RECORD.split(",")]
_KINDS = [pa.int64() if part.split()[1] == "long" else pa.string() for part in RECORD.split(",")]

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def plain_text(page: str) -> str:
    """What a reader sees, see :func:`read_page`."""
    return read_page(page).text


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _value(text: str) -> str:
    """A header value on one line."""
    return " ".join(text.split())


def _uri(url: str) -> str:
    return _CONTROL.sub(lambda found: f"%{ord(found[0]):02X}", url)


def _identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _record(warc_type: str, key: str, uri: str | None, date: str, content_type: str, block: str, refers_to: str | None, payload_digest: str | None, more: list[tuple[str, str]]) -> tuple:
    data = block.encode()
    block_digest = digest(data)
    identifier = _identifier(warc_type, key, uri or "", block_digest)
    headers = [("WARC-Type", warc_type), ("WARC-Record-ID", identifier), ("WARC-Date", date)]
    headers += [("WARC-Target-URI", uri)] if uri is not None else []
    headers += [("WARC-Refers-To", refers_to)] if refers_to else []
    headers += more + [("WARC-Payload-Digest", payload_digest)] if payload_digest else more
    headers += [("WARC-Block-Digest", block_digest), ("Content-Type", content_type), ("Content-Length", str(len(data)))]
    record = f"{VERSION}\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers) + "\r\n" + block + _END
    return warc_type, identifier, refers_to, uri, date, content_type, payload_digest, block_digest, len(data), record


def _response(key: str, url: str | None, page: str, date: str) -> tuple:
    payload = page.encode()
    http = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    block = "HTTP/1.1 200 OK\r\n" + "".join(f"{name}: {value}\r\n" for name, value in http) + "\r\n" + page
    return _record("response", key, None if url is None else _uri(url), date, "application/http; msgtype=response", block, None, digest(payload), [])


def _derived(key: str, response: tuple) -> list[tuple]:
    """The metadata and conversion records of a response; each repeats where it comes from."""
    _, source, _, uri, date, source_type, payload_digest, block_digest, length, record = response
    block = record[record.index("\r\n\r\n") + 4 : -len(_END)]
    head, _, page = block.partition("\r\n\r\n")
    status, *http = head.split("\r\n")
    origin = [("WARC-Refers-To-Target-URI", uri)] if uri is not None else []
    origin.append(("WARC-Refers-To-Date", date))
    told = read_page(page)
    fields = [("source-content-type", source_type), ("source-content-length", str(length)), ("source-block-digest", block_digest)]
    fields += [("source-payload-digest", payload_digest), ("http-status", status)]
    fields += [("http-header", line) for line in http]
    fields += [("title", html.unescape(told.title))] if told.title is not None else []
    fields += [("language", told.language)] if told.language else []
    fields += [("outlink", html.unescape(link)) for link in told.links]
    noted = "".join(f"{name}: {_value(value)}\r\n" for name, value in fields)
    text = told.text
    return [
        _record("metadata", key, uri, date, "application/warc-fields", noted, source, None, origin),
        _record(
            "conversion", key, uri, date, "text/plain; charset=utf-8", text, source, digest(text.encode()),
            origin + [("WARC-Source-Payload-Digest", payload_digest), ("WARC-Identified-Payload-Type", "text/html")],
        ),
    ]


def _built(date: str, kinds: tuple[str, ...]):
    def build(keys: pa.Array, urls: pa.Array, pages: pa.Array) -> pa.Array:
        offsets, rows = [0], []
        for key, url, page in zip(keys.to_pylist(), urls.to_pylist(), pages.to_pylist()):
            key = "" if key is None else str(key)
            response = _response(key, url, page or "", date)
            made = [response] if "response" in kinds else []
            if "metadata" in kinds or "conversion" in kinds:
                made += [record for record in _derived(key, response) if record[0] in kinds]
            rows += made
            offsets.append(len(rows))
        columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
        records = pa.StructArray.from_arrays([pa.array(column, kind) for column, kind in zip(columns, _KINDS)], _NAMES)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), records)

    return build


def build_records(
    pages: DataFrame, kinds: tuple[str, ...] = ("metadata", "conversion"), date: str = "1970-01-01T00:00:00Z",
    id_column: str = "page_id", url_column: str = "url", html_column: str = "html", output: str = "warc",
) -> DataFrame:
    """``pages`` exploded to a struct column ``output``, one row for each record of ``kinds``.

    ``date`` is that of the crawl. A page's response record is built first and its derivatives from
    that record alone: ``metadata`` lists the source's headers, digests, title, language and links,
    ``conversion`` holds the plain text; both name the response's id, uri and date, and the
    conversion its payload digest. Ids are digests of id, uri and content, so a rerun gives the same
    ones, and a row repeated gives the same records again. Null html is an empty page, a null url leaves out the uri; a
    page without text gives an empty conversion. A page is read in time proportional to its length, whatever its markup. ``record`` is the whole record as it stands in a
    WARC file. No row moves; an empty table gives no records. A column named ``output`` raises ValueError; other columns pass through.
    """
    if output in pages.columns:
        raise ValueError(f"there is a column {output} already")
    session_of(pages)
    built = F.arrow_udf(_built(date, kinds), f"array<struct<{', '.join(part.strip().replace(' ', ':', 1) for part in RECORD.split(','))}>>")
    columns = [F.col(id_column).cast("string"), F.col(url_column).cast("string"), F.col(html_column).cast("string")]
    return pages.withColumn(output, F.explode(built(*columns)))


def write_warc(records: DataFrame, path: str, column: str = "warc", compression: str = "gzip") -> None:
    """Write the records as WARC files, one for each task, by Spark's text sink, which ends each with its last line feed."""
    text = F.col(column)["record"]
    records.select(F.substring(text, F.lit(1), F.length(text) - 1)).write.option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: (headers map, block string), the files split between tasks where not compressed.

    The text source cuts at an end of record that a start of record follows. A block that holds such
    a line pair itself would be cut; its length then differs from ``Content-Length``, which raises.
    """
    rows = spark.read.option("lineSep", _END + VERSION + "\r\n").text(path).where("value <> ''")
    text = F.regexp_replace("value", rf"^{VERSION}\r\n", "")  # the first record of a file
    rows = rows.select(text.alias("text")).withColumn("cut", F.instr("text", _END))
    lines = F.split(F.substring("text", F.lit(1), F.col("cut") - 1), "\r\n")
    entry = lambda line: F.struct(F.substring_index(line, ": ", 1).alias("name"), F.regexp_replace(line, "^[^:]*: ", "").alias("value"))
    rows = rows.select(
        F.map_from_entries(F.transform(lines, entry)).alias("headers"),
        F.substring("text", F.col("cut") + len(_END), F.length("text")).alias("rest"),
    )
    more = F.octet_length("rest") - F.element_at("headers", "Content-Length").cast("long")
    last = F.substring("rest", F.lit(1), F.length("rest") - len(_END))  # of a file, with the end of its record
    wrong = F.raise_error(F.lit("a record's block is not of its stated length"))
    block = F.when(more == 0, F.col("rest")).when((more == len(_END)) & F.col("rest").endswith(_END), last).otherwise(wrong)
    return rows.select("headers", block.alias("block"))
