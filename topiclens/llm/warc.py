"""WARC records that are derived from responses: metadata and plain-text conversions.

Each response gives two records that refer to it by its id, keep its target and date, and
name its headers and digests: a `metadata` record of application/warc-fields, with what the
response's headers and page say, and a `conversion` record with the page's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import map_texts
from topiclens.llm.html_lines import read_page

NO_DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"


def record_uri(*parts: Column) -> Column:
    """urn:uuid of a hash of the parts: the same for the same parts, at each run."""
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]).cast("binary"), 256)
    pieces = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)),
              F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", date: str = NO_DATE) -> DataFrame:
    """Response records of a table of pages: (id, record_id, target_uri, date, headers, payload).

    headers: the lines of the HTTP header. A null page is an empty payload.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    return pages.select(
        F.col(f"`{id}`").alias(id),
        record_uri(F.lit("response"), F.col(f"`{id}`"), F.col(f"`{url}`"), payload).alias("record_id"),
        F.col(f"`{url}`").alias("target_uri"),
        F.lit(date).alias("date"),
        F.array(
            F.lit("HTTP/1.1 200 OK"),
            F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
        ).alias("headers"),
        payload.alias("payload"),
    )


def _fields(headers: list[str] | None, page, digest: str) -> str:
    """A block of application/warc-fields: one field a line."""
    status = (headers or [""])[0].split()
    given = [h for h in (headers or [])[1:] if ":" in h]
    lines = [f"http-status: {status[1] if len(status) > 1 else ''}"]
    lines += ["http-header-" + h for h in given]
    lines += [f"payload-digest: {digest}", f"languageOfDocument: {page.lang}", f"title: {page.title}"]
    lines += ["outlink: " + " ".join(h.split()) for h in page.hrefs]
    return "".join(line + "\r\n" for line in lines)


def derivatives(
    rows: DataFrame,
    id: str,
    record_id: str = "record_id",
    target_uri: str = "target_uri",
    date: str = "date",
    headers: str = "headers",
    payload: str = "payload",
) -> DataFrame:
    """Two rows for each response: (id, record_type, record_id, refers_to, target_uri, date,
    content_type, payload_digest, source_headers, block, block_digest, content_length).

    payload_digest is of the response's payload, block_digest of the record's own block; both
    are SHA-256. source_headers repeats what the response had. Record ids
    follow from the response's. A null payload is empty; a null target or date stays null; an
    empty table gives no rows; other columns are not looked at.
    """
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    source = rows.select(
        F.col(f"`{id}`").alias("id"),
        body.alias("payload"),
        F.col(f"`{record_id}`").alias("refers_to"),
        F.col(f"`{target_uri}`").alias("target_uri"),
        F.col(f"`{date}`").alias("date"),
        F.col(f"`{headers}`").alias("headers"),
        digest(body).alias("digest"),
    )
    kind = rows.schema[id].dataType.simpleString()

    def make():
        def apply(ids, payloads, refers, uris, dates, headers, digests):
            pages = [read_page(p) for p in payloads]
            fields = [_fields(h, p, d) for h, p, d in zip(headers, pages, digests)]
            texts = ["\n".join(x.text for x in p.lines) for p in pages]
            return [ids, refers, uris, dates, headers, digests, fields, texts]

        return apply

    read = map_texts(
        source,
        ["id", "payload", "refers_to", "target_uri", "date", "headers", "digest"],
        make,
        f"id {kind}, refers_to string, target_uri string, date string, headers array<string>, "
        "digest string, fields string, text string",
    )
    both = F.array(
        *[
            F.struct(
                F.lit(name).alias("record_type"),
                F.lit(content).alias("content_type"),
                F.col(block).alias("block"),
            )
            for name, content, block in (
                ("metadata", "application/warc-fields", "fields"),
                ("conversion", "text/plain; charset=utf-8", "text"),
            )
        ]
    )
    made = read.select("id", "refers_to", "target_uri", "date", "headers", "digest", F.inline(both))
    return made.select(
        F.col("id").alias(id),
        "record_type",
        record_uri(F.col("record_type"), F.col("refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "date",
        "content_type",
        F.col("digest").alias("payload_digest"),
        F.col("headers").alias("source_headers"),
        "block",
        digest(F.col("block")).alias("block_digest"),
        F.octet_length("block").cast("long").alias("content_length"),
    )


def serialized(records: DataFrame) -> Column:
    """A record as it stands in a file: header lines, an empty line, the block, two line ends."""
    named = [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date"),
        ("WARC-Payload-Digest", "payload_digest"), ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"),
    ]
    lines = [F.concat(F.lit(f"{n}: "), records[c]) for n, c in named]
    lines += [F.concat(F.lit("Content-Length: "), records["content_length"].cast("string"))]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines, F.lit("\r\n")), records["block"], F.lit("\r\n\r\n")).cast("binary")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]
