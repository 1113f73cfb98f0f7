"""WARC derivatives: every response becomes a metadata record and a plain-text conversion record that refer to it.

``responses`` gives landed pages the form of response records; ``derive`` builds the two derivatives in the row of the
response, without a shuffle. Both keep the response's id (WARC-Refers-To), target, date, HTTP header and digests; the
metadata record also names the conversion record. ``write`` writes records as WARC files and ``read`` reads such files
back. All in DataFrame operations.

A digest is ``sha256:`` and lower-case hexadecimal digits. A record id is a UUID made from the MD5 of what identifies
the record, so a repeated run gives equal ids. Null url or payload: empty. Null date: no WARC-Date line. Repeated rows:
equal records with equal ids. Extra columns of ``responses`` and ``derive`` that are named in ``keep`` stay. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.functions import html as htm

VERSION, END = "WARC/1.1", "\r\n"
RECORD = ("record_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "http_header", "payload_digest", "block_digest", "block")


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def octets(text: Column) -> Column:
    return F.octet_length(text)


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:...>`` from the MD5 of the parts, with the marks of a name-based UUID."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def responses(pages: DataFrame, key: str = "page_id", date: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Response records of pages (``key``, url, html)."""
    url, payload = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    header = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), octets(payload).cast("string"), F.lit(END)
    )
    built = pages.select(*keep, F.col(key).cast("string").alias("_key"), url.alias("_url"), payload.alias("_payload"), header.alias("_header"), (date if date is not None else F.lit(None).cast("string")).alias("_date"))
    return built.select(
        *keep,
        F.lit("response").alias("record_type"),
        record_id(F.lit("response"), F.coalesce("_key", F.lit("")), F.col("_url")).alias("record_id"),
        F.lit(None).cast("string").alias("refers_to"),
        F.col("_url").alias("target_uri"),
        F.col("_date").alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.col("_header").alias("http_header"),
        digest(F.col("_payload")).alias("payload_digest"),
        digest(F.concat("_header", F.lit(END), "_payload")).alias("block_digest"),
        F.col("_payload").alias("block"),
    )


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(END))


def derive(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A metadata and a conversion record for each response; ``block`` of a response is its payload.

    Columns: ``keep``, those of ``RECORD`` and ``source_payload_digest``, ``source_block_digest``.
    """
    of = F.coalesce("record_id", F.lit(""))
    page = records.filter(F.col("record_type") == "response").select(
        *keep,
        of.alias("refers_to"),
        record_id(F.lit("metadata"), of).alias("metadata_id"),
        record_id(F.lit("conversion"), of).alias("conversion_id"),
        F.coalesce("target_uri", F.lit("")).alias("target_uri"),
        "warc_date",
        F.coalesce("http_header", F.lit("")).alias("http_header"),
        F.coalesce("payload_digest", F.lit("")).alias("source_payload_digest"),
        F.coalesce("block_digest", F.lit("")).alias("source_block_digest"),
        htm.title(F.col("block")).alias("title"),
        htm.text_nodes(F.col("block")).alias("text"),
        htm.hrefs(F.col("block")).alias("links"),
    )
    links = F.array_join(F.transform("links", lambda u: _field("outlink", F.concat(u, F.lit(" L a/@href")))), "")
    headers = F.array_join(
        F.transform(F.filter(F.split("http_header", END), lambda x: x != ""), lambda x: _field("source-header", x)), ""
    )
    fields = F.concat(
        _field("title", F.col("title")),
        _field("conversion", F.col("conversion_id")),
        _field("source-payload-digest", F.col("source_payload_digest")),
        _field("source-block-digest", F.col("source_block_digest")),
        headers,
        links,
    )
    two = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    made = page.select(*keep, "refers_to", "target_uri", "warc_date", "http_header", "source_payload_digest", "source_block_digest", F.explode(two).alias("r"))
    return made.select(
        *keep,
        "r.record_type",
        "r.record_id",
        "refers_to",
        "target_uri",
        "warc_date",
        "r.content_type",
        "http_header",
        F.lit(None).cast("string").alias("payload_digest"),
        digest(F.col("r.block")).alias("block_digest"),
        "r.block",
        "source_payload_digest",
        "source_block_digest",
    )


def record_text(records: DataFrame) -> DataFrame:
    """``value``: each record as it stands in a file, without the two line ends that close it."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise("")
    block = F.when(F.col("record_type") == "response", F.concat("http_header", F.lit(END), "block")).otherwise(F.col("block"))
    head = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Payload-Digest", F.col("payload_digest")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", octets(block).cast("string")),
    )
    return records.select(F.concat(head, F.lit(END), block).alias("value"))


def write(records: DataFrame, path: str) -> None:
    """One WARC file for each task."""
    record_text(records).write.option("lineSep", END + END).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``RECORD`` and ``whole``: whether the block has the length that its header states."""
    parts = spark.read.option("lineSep", VERSION + END).text(path).filter(F.length(F.trim("value")) > 0)
    head = F.concat(F.substring_index("value", END + END, 1), F.lit(END))
    rest = F.expr(f"substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + 5)")
    cut = parts.select(head.alias("head"), F.regexp_replace(rest, r"\r\n\r\n\z", "").alias("all"))
    get = lambda name: F.nullif(F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)$", 1), F.lit(""))
    is_response = get("WARC-Type") == "response"
    http = F.concat(F.substring_index("all", END + END, 1), F.lit(END))
    body = F.expr(f"substring(all, length(substring_index(all, '\\r\\n\\r\\n', 1)) + 5)")
    return cut.select(
        get("WARC-Type").alias("record_type"),
        get("WARC-Record-ID").alias("record_id"),
        get("WARC-Refers-To").alias("refers_to"),
        get("WARC-Target-URI").alias("target_uri"),
        get("WARC-Date").alias("warc_date"),
        get("Content-Type").alias("content_type"),
        F.when(is_response, http).alias("http_header"),
        get("WARC-Payload-Digest").alias("payload_digest"),
        get("WARC-Block-Digest").alias("block_digest"),
        F.when(is_response, body).otherwise(F.col("all")).alias("block"),
        (octets(F.col("all")) == get("Content-Length").cast("int")).alias("whole"),
    )
