"""A content-addressed web archive: payload bytes once, exact record headers beside them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import staged_dir

#: Digits of base 32: Spark's own, and those of RFC 4648 (fixed values).
DIGITS, RFC_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base 32; four digits from five hexadecimal ones at a time."""
    digest = F.sha1(data)
    four = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*four), DIGITS, RFC_DIGITS)


def write_archive(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> str:
    """Write one WARC record per page; returns the archive's folder.

    ``payloads``: each distinct payload (the html in UTF-8, null as empty) once, under its
    SHA-256; records whose SHA-256 agrees but whose SHA-1 or length differs end the job.
    ``headers``: the exact header block of every record, with the payload's address. Of records with
    equal payloads of at least ``min_bytes`` bytes, the one with the smallest page id is a response
    and others are revisits that refer to it; null ids come last, repeated rows count one by one.
    Line breaks in an url are percent-encoded; a null url is left out of the header. Payloads are kept whole, however
    long; other columns are left out, whatever their names. No rows: an archive without records.
    """
    spark = pages.sparkSession
    path = path or f"{staged_dir(spark)}/archive-{uuid.uuid4().hex}"
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    facts = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({"address": F.sha2("payload", 256), "sha1": sha1_base32(F.col("payload")), "bytes": F.octet_length("payload").cast("long")})
    # a row's number is settled by writing it
    facts.drop("payload").withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{path}/facts")
    rows = spark.read.parquet(f"{path}/facts")

    once = facts.groupBy("address").agg(
        F.first("payload").alias("payload"),
        F.min("bytes").alias("bytes"), F.max("bytes").alias("b"), F.min("sha1").alias("sha1"), F.max("sha1").alias("s"),
    )
    clash = F.raise_error(F.concat(F.lit("two payloads share the digest "), F.col("address"))).cast("long")
    once = once.withColumn("bytes", F.when((F.col("bytes") == F.col("b")) & (F.col("sha1") == F.col("s")), F.col("bytes")).otherwise(clash))
    once.select("address", "bytes", "payload").write.parquet(f"{path}/payloads")

    rank = F.struct(F.col("page_id").isNull().alias("last"), F.col("page_id").alias("page_id"), F.col("row").alias("row"))
    firsts = rows.where(F.col("bytes") >= min_bytes).groupBy("address").agg(F.min(rank).alias("first"))
    rows = rows.join(firsts, "address", "left")
    revisit = F.coalesce(F.col("first.row") != F.col("row"), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    kind = F.when(revisit, "revisit").otherwise("response")
    safe = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = F.concat_ws(
        LINE,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), safe),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first.page_id")))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )
    head = F.encode(F.concat(lines, F.lit(LINE * 2)), "UTF-8")
    rows.select("row", "address", head.alias("header")).write.parquet(f"{path}/headers")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: what their headers say, joined with their payloads.

    ``header`` and ``payload`` are the exact bytes (a revisit has the payload it refers to);
    ``record`` is the record as it stands in a WARC file. Every stored payload is digested anew,
    and one that does not match its address ends the job. ``payload_bytes`` and
    ``payload_digest`` are taken from the bytes; ``stated_digest`` is the header's, and a header that states
    another digest than its payload's, or none, ends the job too. An archive without records gives no rows.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("address"))).cast("long")
    found = F.octet_length("payload").cast("long")
    stored = stored.select(
        "address", "payload",
        F.when((F.sha2("payload", 256) == F.col("address")) & (found == F.col("bytes")), found).otherwise(damaged).alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
    )
    heads = spark.read.parquet(f"{path}/headers")
    said = F.decode("header", "UTF-8")
    field = lambda name, value=r"([^\r]*)": F.nullif(F.regexp_extract(said, rf"\r\n{name}: {value}\r\n", 1), F.lit(""))
    heads = heads.select(
        "header", "address",
        field("WARC-Record-ID", r"<urn:page:(\d+|-\d+)>").cast("long").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To", r"<urn:page:(\d+|-\d+)>").cast("long").alias("refers_to"),
        field("WARC-Payload-Digest", r"sha1:([A-Z2-7]*)").alias("stated_digest"),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    end = F.lit((LINE * 2).encode())
    records = heads.join(stored, "address").withColumn("record", F.concat("header", body, end))
    wrong = F.raise_error(F.concat(F.lit("a header of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(" states another digest")))
    agrees = F.col("stated_digest").eqNullSafe(F.col("payload_digest"))
    return records.withColumn("stated_digest", F.when(agrees, F.col("stated_digest")).otherwise(wrong)).drop("address")
