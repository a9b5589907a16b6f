"""Content-addressed WARC archive.

An archive is two tables.  ``payloads`` holds each distinct payload once under
its SHA-256; the digest of the stored bytes is worked out again on reading.
``headers`` holds the exact header bytes of every record, with the digest of
the record's payload.  ``read_records`` joins the two and gives back the bytes
of the original records.

Of records with the same payload of at least ``MIN_REVISIT`` bytes the one with
the smallest id (a null id counts as largest; of repeated rows one) is a
response record and the others are revisit records that name it.  A revisit
record has no block of its own (Content-Length 0); its payload still is found
by the digest.  Null payloads count as empty, null addresses as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajex.llm.common import checkpoint_dir, note_written, stage

#: Shorter payloads are stored by digest too, but their records are responses.
MIN_REVISIT = 100
CRLF = "\r\n"
#: Fixed profile address of the WARC 1.1 standard for equal payload digests.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


def record_id(identifier: Column, row: Column) -> Column:
    """A record's own name: from the id, or from the row where it has none."""
    return F.concat(F.lit("<urn:record:"), F.coalesce(identifier.cast("string"), F.concat(F.lit("row-"), row.cast("string"))), F.lit(">"))


def header(kind: Column, own: Column, refers: Column, url: Column, date: str, size: Column, sha: Column) -> Column:
    """Exact header bytes of a record, up to and with the empty line."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    revisit = kind == "revisit"
    # a line break inside an address would end the header line
    address = F.regexp_replace(F.coalesce(url, F.lit("")), "[\\r\\n]+", "%0A")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", own), line("WARC-Target-URI", address),
        line("WARC-Date", F.lit(date)), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), sha)),
        line("WARC-Payload-Length", size.cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", refers))).otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))), F.lit(CRLF),
    ).cast("binary")


def write_archive(df: DataFrame, path: str, id_column: str, payload: str, url: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Writes ``path``/payloads and ``path``/headers for one record per row of
    ``df``.  ``payload`` is a string (stored as UTF-8) or binary column."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"").cast("binary"))
    sized = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").alias("url"), body.alias("payload")) \
        .withColumn("digest", digest(F.col("payload")))
    # one row of each payload; copies within a task fall together before the shuffle
    sized.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")

    light = stage(sized.select("id", "url", F.octet_length("payload").cast("long").alias("size"), "digest",
                               F.monotonically_increasing_id().alias("row")), "warc-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    first = light.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min(order).alias("first"))
    revisit = F.col("first").isNotNull() & (F.col("row") != F.col("first.row"))
    kind = F.when(revisit, "revisit").otherwise("response")
    own, refers = record_id(F.col("id"), F.col("row")), record_id(F.col("first.id"), F.col("first.row"))
    light.join(first, "digest", "left").select(
        own.alias("record_id"), header(kind, own, refers, F.col("url"), date, F.col("size"), F.col("digest")).alias("header"),
        "digest").write.parquet(f"{path}/headers")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; fails on bytes that do not have their digest."""
    stored = spark.read.parquet(f"{path}/payloads")
    right = digest(F.col("payload")) == F.col("digest")
    return stored.withColumn("payload", F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload does not match its digest "), F.col("digest")))))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, header, payload (of revisits too) and record: the bytes of
    the original record, header, block and two line ends."""
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"").cast("binary")).otherwise(F.col("payload"))
    return (spark.read.parquet(f"{path}/headers").join(read_payloads(spark, path), "digest")
            .select("record_id", "header", "payload", F.concat("header", block, F.lit(b"\r\n\r\n").cast("binary")).alias("record")))


def header_field(name: str, of: str = "header") -> Column:
    """Value of a header line; an empty string if there is none."""
    return F.regexp_extract(F.col(of).cast("string"), f"(?m)^{name}: ([^\\r\\n]*)", 1)


def named_id(value: Column) -> Column:
    """The id inside a record's name; null for names of rows without one."""
    return F.regexp_extract(value, "^<urn:record:(-?[0-9]+)>$", 1).try_cast("long")


def scratch_archive(spark: SparkSession) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    note_written(spark, path)
    return path


def op10(spark, sf_dir: str) -> DataFrame:
    path = scratch_archive(spark)
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path, "page_id", "html", "url")
    records = read_records(spark, path)
    return records.select(
        named_id(header_field("WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest(F.col("payload")).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        named_id(header_field("WARC-Refers-To")).alias("refers_to"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
