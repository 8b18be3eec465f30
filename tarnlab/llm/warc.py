"""Content-addressed WARC archive.

Payload bytes are stored once, under a strong digest (SHA-256) that is verified
whenever they are read; exact record headers are a separate table. Joining the
two on the digest gives the original records back. Of records with equal payloads
of at least MIN_REVISIT bytes the one with the largest id is the response, the
others are revisits that refer to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_REVISIT = 1000
DATE = "2020-01-01T00:00:00Z"
#: Stands for a null id where ids are compared; no page has it.
NO_ID = -(1 << 63)
CRLF = "\r\n"


@dataclass(frozen=True)
class Archive:
    """Folders of the header table and of the payload store."""

    headers: str
    payloads: str


def record_id(page_id: Column) -> Column:
    """A name-based urn for a page's record."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("none"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header_block(kind: Column, refers_to: Column) -> Column:
    """The WARC header and, after a blank line, the HTTP header: every byte of the record but its payload."""
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    revisit = kind == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    named = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        named("WARC-Type", kind),
        named("WARC-Record-ID", record_id(F.col("page_id"))),
        named("WARC-Date", F.lit(DATE)),
        F.when(uri != "", named("WARC-Target-URI", uri)).otherwise(""),
        F.when(F.col("page_id").isNotNull(), named("X-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        named("X-Payload-SHA256", F.col("digest")),
        F.when(
            revisit,
            F.concat(
                named("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                F.when(refers_to.isNotNull(), F.concat(named("WARC-Refers-To", record_id(refers_to)), named("X-Refers-To-Page-ID", refers_to.cast("string")))).otherwise(""),
            ),
        ).otherwise(""),
        named("Content-Type", F.lit("application/http;msgtype=response")),
        named("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(pages: DataFrame, folder: str | None = None) -> Archive:
    """Write a record for every row of pages (page_id, url, html), to a new folder or, without one, for this application only.

    A null html is an empty payload; a null url leaves its header line out. Rows with
    a null id carry no page id and are a response only where no copy has an id.
    Repeated rows of the largest id are all responses; their payload is still stored
    once. Payloads smaller than MIN_REVISIT are stored once too, but all their
    records are responses. Very long payloads are stored whole, one to a row. An empty table gives an archive without records; other
    columns are ignored.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("id", F.coalesce("page_id", F.lit(NO_ID)))
    keys = rows.select("page_id", "id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    kept = common.materialize(keys.groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("rows")), "warc-kept")

    folder = folder or common.scratch(spark, "warc")
    out = Archive(f"{folder}/headers", f"{folder}/payloads")
    # the kept row of each digest brings the bytes: ids are unique there, so no key is hot
    once = rows.select("id", "digest", "payload").join(kept.select("digest", F.col("kept").alias("id")), ["id", "digest"])
    once.dropDuplicates(["id", "digest"]).select("digest", "payload").write.option("compression", "zstd").parquet(out.payloads)

    whole = common.hot_join(keys, kept, "digest", drop="rows")
    own = (F.col("payload_bytes") < MIN_REVISIT) | (F.col("id") == F.col("kept"))
    kind = F.when(own, "response").otherwise("revisit")
    to = F.when(~own & (F.col("kept") != NO_ID), F.col("kept"))
    whole.select(_header_block(kind, to).alias("header"), "digest").write.option("compression", "zstd").parquet(out.headers)
    return out


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """The stored payloads, each verified: digest, payload, payload_bytes, payload_digest (SHA-1).

    Bytes that don't match their address stop the read.
    """
    rows = spark.read.schema("digest string, payload binary").parquet(archive.payloads)
    sound = F.sha2("payload", 256) == F.col("digest")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("string")
    return rows.select(
        F.when(sound, F.col("digest")).otherwise(damaged).alias("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Records rebuilt by joining headers and payloads.

    Returns page_id, record_type, refers_to (read from the header's lines), header,
    payload, payload_bytes, payload_digest and record: the exact bytes (a revisit's
    ends after its HTTP header). Columns that aren't used are pruned, so a query that
    needs no bytes moves none.
    """
    headers = spark.read.schema("header string, digest string").parquet(archive.headers)
    line = lambda name: F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    number = lambda name: F.nullif(line(name), F.lit("")).cast("long")
    record_type = line("WARC-Type")
    body = F.when(record_type == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return common.salted_join(headers, read_payloads(spark, archive), "digest").select(
        number("X-Page-ID").alias("page_id"),
        record_type.alias("record_type"),
        number("X-Refers-To-Page-ID").alias("refers_to"),
        "header",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.concat(F.col("header").cast("binary"), body, F.lit((CRLF + CRLF).encode())).alias("record"),
    )
