"""A content-addressed WARC archive: headers of all records, payloads once.

Two tables in one folder:

* payloads (address, payload_digest, payload_bytes, payload): each distinct
  payload once, addressed by its SHA-256.
* records (page_id, record_id, address, block_bytes, header, http_header): the
  exact header bytes of each record. Of records with equal payloads that with
  the smallest id is the response, the others revisit it and hold no payload.

A record is its header, a blank line, its block (the HTTP header and, in a
response, the payload) and two line ends; `records` puts the bytes together by
joining both tables. On reading, payloads are checked against their address and
their digest, and records against their payload; what does not fit fails the
read, and is never passed over.

A null payload is empty. Null ids come after all others: such a record revisits
the smallest id of its payload; records of equal ids with equal payloads are
all responses if theirs is the smallest, and so are those of a payload without
any id. A null URL is an empty one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from simmart.llm.common import new_folder, prepared
from simmart.operators.skew import splittable_join

# Base 32 digits (RFC 4648), and those that conv() writes.
_DIGITS, _CONV = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_LINE = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: forty hex digits in four parts of eight digits each."""
    hex_ = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hex_, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _CONV, _DIGITS)


def _facts(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"").cast("binary"))
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload")
    )
    return rows.withColumn("address", F.unhex(F.sha2("payload", 256)))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes one record per row into an empty folder."""
    prepared(pages.sparkSession)
    facts = _facts(pages, key, url, html)
    payloads = facts.groupBy("address").agg(F.min("page_id").alias("first_id"), F.any_value("payload").alias("payload"))
    payloads.select(
        "address",
        "first_id",
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        "payload",
    ).write.parquet(f"{path}/payloads")

    known = pages.sparkSession.read.parquet(f"{path}/payloads").drop("payload")
    # The payload itself is not shuffled again: its address stands for it.
    joined = splittable_join(facts.select("page_id", "url", "address"), known, ["address"])
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_LINE * 2),
    )
    # A line end within a URL would end the header line.
    target = F.regexp_replace("url", "[\r\n]", " ")
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = F.concat_ws(
        _LINE,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("first_id")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    )
    joined.select(
        "page_id",
        "address",
        F.encode(F.concat(lines, F.lit(_LINE * 2)), "UTF-8").alias("header"),
        F.encode(http, "UTF-8").alias("http_header"),
    ).write.parquet(f"{path}/records")


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, f"\r\n{name}: ([^\r\n]*)\r\n", 1)


def _verified(spark: SparkSession, path: str) -> DataFrame:
    """The payloads; reading one that does not match its address fails."""
    found = spark.read.parquet(f"{path}/payloads")
    whole = (F.unhex(F.sha2("payload", 256)) == F.col("address")) & (base32_sha1(F.col("payload")) == F.col("payload_digest"))
    failure = F.raise_error(F.concat(F.lit("damaged payload "), F.hex("address"))).cast("binary")
    return found.withColumn("payload", F.when(whole, F.col("payload")).otherwise(failure))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, read from its header: page_id, payload_bytes,
    payload_digest, record_type, refers_to, and url. The read fails if a record
    has no payload, or one of another digest or length."""
    headers = spark.read.parquet(f"{path}/records").select("address", "http_header", F.decode("header", "UTF-8").alias("header"))
    payloads = _verified(spark, path).select(
        "address",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("found_digest"),
    )
    joined = splittable_join(headers, payloads, ["address"], "left")
    named = F.regexp_extract(_field(F.col("header"), "WARC-Record-ID"), "<urn:page:(-?[0-9]+)>", 1)
    refers = F.regexp_extract(_field(F.col("header"), "WARC-Refers-To"), "<urn:page:(-?[0-9]+)>", 1)
    digest = F.regexp_extract(_field(F.col("header"), "WARC-Payload-Digest"), "sha1:(.*)", 1)
    kind = _field(F.col("header"), "WARC-Type")
    length = F.octet_length("http_header") + F.when(kind == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    fits = (digest == F.col("found_digest")) & (_field(F.col("header"), "Content-Length") == length.cast("string"))
    failure = F.raise_error(F.concat(F.lit("record without its payload: "), F.col("header")))
    return joined.select(
        F.when(named != "", named).cast("bigint").alias("page_id"),
        "payload_bytes",
        F.when(fits, digest).otherwise(failure).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(refers != "", refers).cast("bigint").alias("refers_to"),
        _field(F.col("header"), "WARC-Target-URI").alias("url"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record, payload): the exact bytes of each WARC record, and
    the payload that its page had, also where the record is a revisit."""
    headers = spark.read.parquet(f"{path}/records")
    joined = splittable_join(headers, _verified(spark, path).select("address", "payload"), ["address"])
    response = _field(F.decode("header", "UTF-8"), "WARC-Type") == "response"
    body = F.when(response, F.col("payload")).otherwise(F.lit(b"").cast("binary"))
    end = F.lit(f"{_LINE}{_LINE}".encode()).cast("binary")
    return joined.select("page_id", F.concat("header", "http_header", body, end).alias("record"), "payload")


def archived(pages: DataFrame) -> DataFrame:
    """The pages, written to an archive in the shared folder and read back."""
    spark = prepared(pages.sparkSession)
    path = new_folder(spark, "archive")
    write_archive(pages, path)
    return read_archive(spark, path)
