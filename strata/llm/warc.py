"""WARC derivative builder: responses become linked metadata and conversion records.

Built from column functions only. Every record is a row (``record_id``, ``type``,
``refers_to``, ``target_uri``, ``date``, ``headers``, ``block``); record ids are
derived from content, so a job that runs again writes the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2026-01-01T00:00:00Z"

#: Elements that start a new line in the plain text.
_BLOCKS = "p|div|br|li|ul|ol|h[1-6]|tr|table|title|article|section|header|footer|nav|blockquote|pre"
#: Character references that are decoded (the ampersand last).
_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def urn(*parts: Column) -> Column:
    """A record id from the md5 of the parts, as a urn of UUID form."""
    h = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of crawled pages; a null url or body counts as empty."""
    uri, body = F.coalesce(pages[url_col], F.lit("")), F.coalesce(pages[html_col], F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF + CRLF))
    out = pages.select(pages[id_col].cast("long").alias("page_id"), uri.alias("target_uri"), head.alias("head"), body.alias("body"))
    return out.select(
        "page_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "body").alias("record_id"),
        "target_uri", F.lit(date).alias("date"), F.concat("head", "body").alias("block"),
        digest(F.concat("head", "body")).alias("block_digest"), digest(F.col("body")).alias("payload_digest"))


def plain_text(html: Column) -> Column:
    """Text of a page: no comments, scripts, styles or tags; a line for each block element; blanks collapsed."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tag in ("script", "style"):
        t = F.regexp_replace(t, rf"(?is)<{tag}[^>]*>.*?</{tag}\s*>", "")
    t = F.regexp_replace(t, rf"(?i)</?({_BLOCKS})(\s[^>]*)?/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for name, char in _REFERENCES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")


def _split(block: Column) -> tuple[Column, Column]:
    """HTTP head and body of a response block; without an empty line all is body."""
    at = F.instr(block, CRLF + CRLF)
    return (F.when(at > 0, F.substring(block, F.lit(1), at - 1)).otherwise(F.lit("")),
            F.when(at > 0, F.substring(block, at + 4, F.length(block))).otherwise(block))


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata`` (warc-fields: title, language,
    outlinks, the source's HTTP headers and digests) and ``conversion`` (plain text).

    Both refer to the response's id and keep its target URI and date; the conversion
    record also names its metadata record. Input: ``page_id, record_id, target_uri, date, block,
    block_digest, payload_digest``. A null block counts as empty; repeated responses
    give repeated records; other columns are dropped; no rows give no rows.
    """
    block = F.coalesce("block", F.lit(""))
    head, body = _split(block)
    r = records.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "block_digest", "payload_digest",
                       head.alias("head"), body.alias("body"))
    title = F.regexp_replace(F.regexp_extract("body", r"(?is)<title[^>]*>(.*?)</title\s*>", 1), r"\s+", " ")
    lang = F.regexp_extract("body", r"(?i)<html[^>]*\slang=[\"']?([a-zA-Z-]+)", 1)
    r = r.select("*", plain_text(F.col("body")).alias("text"), F.trim(title).alias("title"), lang.alias("language"),
                 F.regexp_count("body", F.lit(r"(?i)<a\s[^>]*href=")).alias("outlinks"))
    fields = F.concat(
        F.lit("title: "), "title", F.lit(CRLF + "language: "), "language", F.lit(CRLF + "outlinks: "), F.col("outlinks").cast("string"),
        F.lit(CRLF + "source-block-digest: "), F.coalesce("block_digest", F.lit("")),
        F.lit(CRLF + "source-payload-digest: "), F.coalesce("payload_digest", F.lit("")),
        # the source's headers, each as a field of its own
        F.when(F.col("head") == "", F.lit("")).otherwise(F.concat(
            F.lit(CRLF + "source-header: "), F.replace(F.col("head"), F.lit(CRLF), F.lit(CRLF + "source-header: ")))), F.lit(CRLF))
    r = r.withColumn("fields", fields)
    r = r.select("*", urn(F.lit("metadata"), "refers_to", "fields").alias("metadata_id"),
                 urn(F.lit("conversion"), "refers_to", "text").alias("conversion_id"))
    return r.select("page_id", "refers_to", "target_uri", "date", F.explode(F.array(
        F.struct(F.lit("metadata").alias("type"), F.col("metadata_id").alias("record_id"), F.lit(None).cast("string").alias("linked_to"),
                 F.lit("application/warc-fields").alias("content_type"), F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.col("conversion_id").alias("record_id"), F.col("metadata_id").alias("linked_to"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))).alias("d")).select(
        "page_id", "d.type", "d.record_id", "refers_to", "d.linked_to", "target_uri", "date", "d.content_type", "d.block",
        digest(F.col("d.block")).alias("block_digest"))


def serialised(records: DataFrame) -> DataFrame:
    """``record``: the whole WARC/1.1 record of each row, without the two closing line ends."""
    line = lambda name, value: F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)))
    return records.select(F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Concurrent-To", F.col("linked_to")), line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")), F.lit("Content-Length: "),
        F.octet_length(F.coalesce("block", F.lit(""))).cast("string"), F.lit(CRLF + CRLF), F.coalesce("block", F.lit(""))).alias("record"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one file per task."""
    serialised(records).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files whose blocks are UTF-8 text: ``type, record_id, refers_to,
    linked_to, target_uri, date, content_type, block, block_digest``.

    Files are cut where a version line follows two line ends; ``whole`` tells whether
    the block has the length that its header gives (a block that holds such a line itself has not).
    """
    raw = spark.read.option("lineSep", CRLF + CRLF + "WARC/1.1" + CRLF).text(path).select(
        F.regexp_replace("value", rf"^WARC/1\.1{CRLF}", "").alias("v"))
    at = F.instr("v", CRLF + CRLF)
    raw = raw.select(F.concat(F.lit(CRLF), F.substring("v", F.lit(1), at - 1), F.lit(CRLF)).alias("head"),
                     F.substring("v", at + 4, F.length("v")).alias("rest"))
    get = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    size = get("Content-Length").cast("int")
    # a file's last record still has the two line ends that close it
    block = F.when(F.octet_length("rest") == size + 4, F.regexp_replace("rest", r"\r\n\r\n$", "")).otherwise(F.col("rest"))
    return raw.select(get("WARC-Type").alias("type"), get("WARC-Record-ID").alias("record_id"), get("WARC-Refers-To").alias("refers_to"),
                      get("WARC-Concurrent-To").alias("linked_to"), get("WARC-Target-URI").alias("target_uri"), get("WARC-Date").alias("date"),
                      get("Content-Type").alias("content_type"), block.alias("block"), get("WARC-Block-Digest").alias("block_digest"),
                      (F.octet_length(block) == size).alias("whole"))
