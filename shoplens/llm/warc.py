"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record yields two records that refer to it by its identifier: a
``metadata`` record (title, language, charset, outgoing links, the response's
HTTP headers) and a ``conversion`` record (the text of the page's blocks, one a
line). Both repeat the target URI, the date and the source's payload digest,
and carry the digest and length of their own block. Identifiers are name-based
(from type, URI, row id and payload digest), so a recomputed task gives the
same records.

Files: :func:`write_warc` writes records as gzip WARC/1.1, one file a
partition; :func:`read_warc` reads such files back, a file a task.

Defined cases: null html is an empty payload; null URI is the empty URI; an
empty page has an empty conversion block; equal rows give records with equal
identifiers; header values keep no line breaks; pages of any length are
converted whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import html as entities
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_rows, prepare, spread, table, texts_of
from shoplens.llm.gbt_html import Page

DATE = "1970-01-01T00:00:00Z"
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z0-9-]+)""", re.I)
CHARSET = re.compile(r"""<meta\b[^>]*?\bcharset\s*=\s*["']?([A-Za-z0-9_-]+)""", re.I)
LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
DERIVED = "derived array<struct<type: string, content_type: string, block: string, block_digest: string, content_length: bigint>>"


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of fetched pages: identifier, target URI, date, HTTP
    header, payload and payload digest."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    digest = F.concat(F.lit("sha256:"), F.sha2(payload, 256))
    url = F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]+", " ")
    header = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"))
    return pages.select(
        F.col(id_col).alias("source_row"), _uuid(F.lit("response"), url, F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest).alias("record_id"),
        url.alias("target_uri"), F.lit(date).alias("date"), header.alias("http_header"), payload.alias("payload"), digest.alias("payload_digest"),
    )


def blocks_of(html: str, http_header: str) -> tuple[str, str]:
    """The blocks of the metadata and of the conversion record."""
    line = lambda v: " ".join(entities.unescape(v).split())
    fields = []
    seen = HIDDEN.sub(" ", html)
    for name, found in (("title", TITLE.search(seen)), ("languageOfPage", LANG.search(seen)), ("charset", CHARSET.search(seen))):
        if found:
            fields.append((name, line(found[1])))
    fields += [("outlink", line("".join(m))) for m in LINK.findall(seen)]
    fields += [("source-header", h) for h in http_header.split("\r\n") if h]
    return "".join(f"{k}: {v}\r\n" for k, v in fields), "\n".join(text for _, text in Page(html).blocks)


def derive(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of response records."""
    prepare(records.sparkSession)

    def run(batch):
        out = []
        for html, header in zip(texts_of(batch, "payload"), texts_of(batch, "http_header"), strict=True):
            each = []
            for kind, content, block in zip(("metadata", "conversion"), ("application/warc-fields", "text/plain; charset=utf-8"), blocks_of(html, header), strict=True):
                raw = block.encode()
                each.append({"type": kind, "content_type": content, "block": block, "block_digest": "sha256:" + hashlib.sha256(raw).hexdigest(), "content_length": len(raw)})
            out.append(each)
        return {"derived": out}

    kept = ["source_row", "record_id", "target_uri", "date", "payload_digest"]
    rows = map_rows(spread(records.select(*kept, "payload", "http_header")), kept, DERIVED, run)
    rows = rows.select(*kept, F.explode("derived").alias("d"))
    return rows.select(
        "source_row", F.col("d.type").alias("type"), _uuid(F.col("d.type"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", F.col("payload_digest").alias("source_digest"), "d.content_type", "d.block_digest", "d.content_length", "d.block",
    )


def header_of() -> Column:
    """The WARC header of a derived record, blank line included."""
    fields = {
        "WARC-Type": "type", "WARC-Record-ID": "record_id", "WARC-Date": "date", "WARC-Target-URI": "target_uri", "WARC-Refers-To": "refers_to",
        "WARC-Source-Payload-Digest": "source_digest", "WARC-Block-Digest": "block_digest", "Content-Type": "content_type", "Content-Length": "content_length",
    }
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), F.col(c).cast("string"), F.lit("\r\n")) for k, c in fields.items()], F.lit("\r\n"))


def write_warc(records: DataFrame, path: str) -> None:
    """Derived records as gzip WARC files."""
    records.select(F.concat(header_of(), F.col("block")).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of gzip WARC files: header (map) and block."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for raw in b.column(0).to_pylist():
                raw, at, heads, blocks = gzip.decompress(raw), 0, [], []
                while at < len(raw):
                    end = raw.index(b"\r\n\r\n", at)
                    head = dict(x.split(": ", 1) for x in raw[at:end].decode().split("\r\n")[1:])
                    n = int(head["Content-Length"])
                    heads.append(list(head.items()))
                    blocks.append(raw[end + 4 : end + 4 + n].decode())
                    at = end + 4 + n + 4
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.string())], names=["header", "block"])

    return files.mapInArrow(run, "header map<string,string>, block string")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records of all pages."""
    return derive(responses(table(spark, sf_dir, "pages"))).withColumnRenamed("source_row", "page_id").withColumn("header", header_of())
