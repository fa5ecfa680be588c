"""A content-addressed WARC archive.

Writing keeps two tables: ``payloads`` holds each payload once, under its SHA-256
digest, and ``records`` holds the exact header block of every record with the
digest that its payload has.  Reading joins the two back, verifies each payload
against its digests, and rebuilds the records byte for byte.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the
largest page id is a response and the others revisit it; smaller payloads are all
responses.

Defined results: a null html is an empty payload; a null url is written as an
empty target; line breaks in a url, which would end its header line, are written as
%0D and %0A.  Null page ids count as smallest.  Rows that repeat the largest id
and its payload are responses all.  An empty table gives an empty archive.  Only
``page_id``, ``url`` and ``html`` are read; other columns may have any name.  A long
payload has to fit in a row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import BROADCAST_BYTES, broadcast_within, materialise, measured, work_dir

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


def _base32(sha1: Column) -> Column:
    """40 hex digits in base32: ten of them are eight of its characters."""
    part = lambda i: F.lpad(F.conv(F.substring(sha1, 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*map(part, range(4))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))


def digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, address`` (SHA-256), ``sha1`` (bare base32) and ``payload_bytes``."""
    body = pages.select("page_id", "url", _payload().alias("b"))
    return body.select(
        "page_id", "url", F.sha2("b", 256).alias("address"), _base32(F.sha1("b")).alias("sha1"), F.octet_length("b").cast("long").alias("payload_bytes")
    )


def _header() -> Column:
    """The header block of one record, without the blank line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = F.col("record_type") == "revisit"
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.coalesce(F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, line("WARC-Refers-To", name("refers_to"))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    )


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, max_broadcast: int = BROADCAST_BYTES) -> None:
    """Write ``path/records`` and ``path/payloads``.

    Payloads are hashed once for the digest table, all of whose joins are without
    them.  Only rows that are the response of their digest keep the payload; while the
    digests are few enough to broadcast, payloads are not shuffled at all.
    """
    kind = pages.schema["page_id"].dataType
    each = materialise(digests(pages), "digests")
    last = each.groupBy(F.col("address").alias("of")).agg(F.max("page_id").alias("last"))
    last = materialise(last, "responses")
    known = each.join(last, F.col("address") == F.col("of")).drop("of")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last"))
    known = known.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    known = known.withColumn("refers_to", F.when(revisit, F.col("last")).otherwise(F.lit(None).cast(kind)))
    known.select("page_id", _header().alias("header"), "address").write.parquet(f"{path}/records")
    own = (F.col("address") == F.col("of")) & F.col("page_id").eqNullSafe(F.col("last"))
    body = pages.select("page_id", _payload().alias("payload")).withColumn("address", F.sha2("payload", 256))
    keep = body.join(broadcast_within(last, max_broadcast), own, "left_semi").select("address", "payload")
    if each.join(last, own, "left_semi").count() > last.count():  # the input repeats rows
        keep = keep.dropDuplicates(["address"])
    keep.write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, header, payload, address`` of every record, its payload joined back and verified.

    A record whose payload is missing or fails a digest raises an error: an archive
    that does not return what it was given is of no use.  Payloads are verified where
    they lie, once each.  Headers that are small together are sent to them; otherwise
    both sides are shuffled by digest, each payload once.
    """
    stored = spark.read.parquet(f"{path}/payloads").withColumnRenamed("address", "of")
    stored = stored.withColumns({"sound": F.sha2("payload", 256) == F.col("of"), "weak": F.concat(F.lit("sha1:"), _base32(F.sha1("payload")))})
    records = spark.read.parquet(f"{path}/records")
    if measured(records) <= max_broadcast:
        # An outer join cannot be broadcast from the side it keeps, so records without a payload are looked for apart.
        lost = records.join(stored.select("of"), F.col("address") == F.col("of"), "left_anti").withColumns({"payload": F.lit(None).cast("binary"), "good": F.lit(False)})
        both = stored.join(F.broadcast(records), F.col("address") == F.col("of"))
        both = both.withColumn("good", F.col("sound") & (_field("WARC-Payload-Digest") == F.col("weak")))
        both = both.select("page_id", "header", "address", "payload", "good").unionByName(lost)
    else:
        both = records.join(stored, F.col("address") == F.col("of"), "left")
        both = both.withColumn("good", F.col("sound") & (_field("WARC-Payload-Digest") == F.col("weak")))
    wrong = F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("address"))).cast("binary")
    body = F.when(F.coalesce("good", F.lit(False)), F.col("payload")).otherwise(wrong)
    return both.select("page_id", "header", body.alias("payload"), "address")


def _record() -> Column:
    """The bytes of a record from its ``header`` and ``payload``; a revisit has no body."""
    end = F.encode(F.lit(CRLF), "utf-8")
    body = F.when(F.col("header").contains("WARC-Type: revisit"), F.encode(F.lit(""), "utf-8")).otherwise(F.col("payload"))
    return F.concat(F.encode("header", "utf-8"), end, body, end, end)


def warc_records(records: DataFrame) -> DataFrame:
    """``page_id`` and ``record``: the bytes of each WARC record, as a .warc file holds them."""
    return records.select("page_id", _record().alias("record"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def index(spark: SparkSession, path: str, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """What the records say of themselves, what their payloads are, and a digest of each record as it was put together again."""
    back = read_archive(spark, path, max_broadcast).withColumn("record", _record())
    ref = F.regexp_extract(_field("WARC-Refers-To"), r"^<urn:page:(.*)>$", 1)
    return back.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.when(ref != "", ref).cast(back.schema["page_id"].dataType).alias("refers_to"),
        F.upper(F.sha1("payload")).alias("payload_sha1_hex"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 over ``pages``: archive them, rebuild every record from the archive, and report each."""
    path = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return index(spark, path)


#: Base32 of a digest: its hex, five characters for every four hex digits of 20 bits.
_LINE = lambda name, value: f"'{name}: ' || {value} || chr(13) || chr(10)"
SQL = rf"""
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages
), h AS (
  SELECT page_id, url, b, octet_length(b) AS n, sha1(b) AS s, max(page_id) OVER (PARTITION BY sha256(b)) AS last FROM p
), c AS (
  SELECT *, page_id = last AS whole, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((CAST('0x' || substr(s, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS d FROM h
), r AS (
  SELECT *, encode('WARC/1.1' || chr(13) || chr(10) || {_LINE("WARC-Type", "CASE WHEN whole THEN 'response' ELSE 'revisit' END")} || {_LINE("WARC-Record-ID", "'<urn:page:' || page_id || '>'")}
    || {_LINE("WARC-Date", f"'{DATE}'")} || {_LINE("WARC-Target-URI", "replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A')")} || {_LINE("WARC-Payload-Digest", "'sha1:' || d")}
    || CASE WHEN whole THEN '' ELSE {_LINE("WARC-Refers-To", "'<urn:page:' || last || '>'")} || {_LINE("WARC-Profile", "'http://netpreserve.org/warc/1.1/revisit/identical-payload-digest'")} END
    || {_LINE("Content-Type", "'text/html; charset=utf-8'")} || {_LINE("Content-Length", "CASE WHEN whole THEN n ELSE 0 END")} || chr(13) || chr(10))
    || CASE WHEN whole THEN b ELSE encode('') END || encode(chr(13) || chr(10) || chr(13) || chr(10)) AS record FROM c
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN whole THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN whole THEN NULL ELSE last END AS refers_to, upper(s) AS payload_sha1_hex, CAST(octet_length(record) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256
FROM r
"""
