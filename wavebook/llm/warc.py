"""A content-addressed web archive: payloads stored once, record headers kept exactly.

``headers`` holds one row per record: the bytes of its WARC header and of its HTTP header,
and the digest of its payload. ``payloads`` holds each payload once under its SHA-256 and
length. Reading joins the two on both, checks every payload against its digest, and gives the record
back byte for byte: WARC header, HTTP header and payload for a response; WARC header and
HTTP header for a revisit, which names the response it repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.llm.common import fresh

#: Payloads shorter than this are never replaced by a revisit.
REVISIT_BYTES = 1000
CRLF = "\r\n"
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A digest is hot from this share of all rows on; there are at most 1/HOT of them.
HOT = 0.001


def _uri(url: Column) -> Column:
    """The address on one line: white space and control characters are percent-encoded."""
    kept = F.regexp_replace(F.coalesce(url, F.lit("about:blank")), "[\\p{Cntrl}\\s]", "%20")
    return F.when(F.length(kept) == 0, F.lit("about:blank")).otherwise(kept)


def _record_id(page: Column, url: Column, sha1: Column) -> Column:
    """A name-based UUID of the page, so writing again gives the same record."""
    name = F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), sha1)
    digest = F.sha1(name.cast("binary"))
    uuid = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lit("8"), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url and payload facts of every page; a null page is an empty payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        "page_id",
        "url",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("sha256"),
    )


def keepers(facts: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(sha256, payload_bytes, keeper, copies) of payloads that occur more than once."""
    return (
        facts.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("sha256", "payload_bytes")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def with_keepers(facts: DataFrame, kept: DataFrame) -> DataFrame:
    """Add ``keeper`` to every page whose payload is repeated.

    Digests that hold a thousandth of all rows or more go by broadcast, a thousand of them
    at most; the rest is a plain join in which no key is large.
    """
    rows = facts.count()
    hot = F.col("copies") >= F.lit(max(2.0, rows * HOT))
    keys = ["sha256", "payload_bytes"]
    names = [*keys, "keeper"]
    first, rest = fresh("hot"), fresh("rest")
    marked = facts.join(
        F.broadcast(kept.where(hot).select(*keys, F.col("keeper").alias(first))), keys, "left"
    )
    common = marked.where(F.col(first).isNotNull()).withColumn("keeper", F.col(first)).drop(first)
    others = (
        marked.where(F.col(first).isNull())
        .drop(first)
        .join(kept.where(~hot).select(*names), keys, "left")
    )
    return common.select(*facts.columns, "keeper").unionByName(others.select(*facts.columns, "keeper"))


def write_archive(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write a record per page (page_id, url, html) into the folder.

    Of pages with equal payloads of at least ``revisit_bytes``, the one with the largest
    page_id is a response and the others revisit it; all others are responses. Null html is
    an empty payload; a null or empty url becomes about:blank; pages without page_id are
    responses unless a page with an id has the same payload. Rows repeating the largest page_id are
    all responses. Further columns are not read; an empty table makes an empty archive.
    """
    # written first: the copies are looked up twice, and the pages need not be read again
    spark = pages.sparkSession
    digests(pages).write.mode("errorifexists").parquet(f"{folder}/facts")
    facts = spark.read.parquet(f"{folder}/facts")
    keepers(facts, revisit_bytes).write.mode("errorifexists").parquet(f"{folder}/keepers")
    marked = with_keepers(facts, spark.read.parquet(f"{folder}/keepers"))
    revisit = F.coalesce(F.col("page_id") != F.col("keeper"), F.col("keeper").isNotNull())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(CRLF),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("sha1"))),
        _line("WARC-Date", F.lit(CAPTURED)),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.coalesce(_line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", F.lit(PROFILE)),
                _line("X-Refers-To-Page-ID", F.col("keeper").cast("string")),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(CRLF),
    )
    marked.select(
        header.cast("binary").alias("warc_header"),
        http.cast("binary").alias("http_header"),
        "sha256",
        "payload_bytes",
    ).write.mode("errorifexists").parquet(f"{folder}/headers")
    _write_payloads(pages, folder)


def _write_payloads(pages: DataFrame, folder: str) -> None:
    """Each payload once; copies are dropped before and after the shuffle."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages.select(
        F.sha2(payload, 256).alias("sha256"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload.alias("payload"),
    ).groupBy("sha256", "payload_bytes").agg(F.first("payload").alias("payload")).write.mode(
        "errorifexists"
    ).parquet(f"{folder}/payloads")


def _field(name: str) -> Column:
    value = F.regexp_extract(F.col("warc_header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.nullif(value, F.lit(""))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive, rebuilt from its header and its payload.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest (SHA-1 of the payload
    found, in hexadecimal), payload, block (the exact bytes after the WARC header) and
    warc_header. A payload that is missing or does not have its digest raises an error.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    # checked once per payload, and before the join, so that who asks for no payload moves none
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "sha256",
        "payload_bytes",
        "payload",
        F.sha1("payload").alias("sha1"),
        (
            (F.sha2("payload", 256) == F.col("sha256"))
            & (F.octet_length("payload") == F.col("payload_bytes"))
        ).alias("sound"),
    )
    joined = headers.join(payloads, ["sha256", "payload_bytes"], "left")
    digest = F.when(F.col("sound"), F.col("sha1")).otherwise(
        F.raise_error(F.concat(F.lit("no sound payload "), F.col("sha256"))).cast("string")
    )
    records = joined.select(
        _field("X-Page-ID").cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        "payload_bytes",
        digest.alias("payload_digest"),
        "payload",
        "http_header",
        "warc_header",
    )
    whole = F.when(F.col("record_type") == "revisit", F.col("http_header")).otherwise(
        F.concat(F.col("http_header"), F.col("payload"))
    )
    return records.withColumn("block", whole)


def record_bytes(records: DataFrame) -> DataFrame:
    """(page_id, record): the bytes of each record as they stand in a WARC file."""
    end = F.lit(CRLF + CRLF).cast("binary")
    return records.select("page_id", F.concat("warc_header", "block", end).alias("record"))


def export_warc(records: DataFrame, path: str) -> None:
    """Write the records as WARC files, one per task, each record closed by two line ends."""
    text = F.concat("warc_header", "block").cast("string")
    records.select(text.alias("value")).write.option("lineSep", CRLF + CRLF).text(path)
