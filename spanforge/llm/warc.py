"""A content-addressed WARC archive.

Two written tables hold the archive: ``payloads`` has every distinct payload once, by its
SHA-256 digest; ``headers`` has the exact bytes of each record's WARC and HTTP headers with the
digest they refer to. A record is put together again by a join on the digest, after every
payload's digest has been computed anew and compared.

Edge cases: a null body is an empty payload; payloads under ``revisit_bytes`` never make
revisits; repeated rows with one page_id and payload give one response and revisits to it; a null
page_id comes after all others and is written as ``null``; a null url is ``urn:page:<id>``;
control characters and spaces in a url are percent-encoded; an empty table gives an empty
archive; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.session import cut, scratch_path

CRLF = "\r\n"


def write_archive(
    pages: DataFrame,
    path: str | None = None,
    body: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    revisit_bytes: int = 100,
) -> str:
    """Write pages(page_id, url, <body>) as an archive under path; the path is returned."""
    path = path or scratch_path(pages.sparkSession, "archive")
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    digest = F.sha2(payload, 256)
    light = pages.select("page_id", "url", digest.alias("digest"), F.octet_length(payload).cast("bigint").alias("bytes"))
    light = cut(light.groupBy("digest", "bytes", "page_id", "url").agg(F.count("*").alias("same")))

    # the first record of every digest; only ids and digests are shuffled, and summed up first
    place = F.struct(F.col("page_id").isNull().alias("no_id"), F.coalesce("page_id", F.lit(0)).alias("id"), F.col("url").isNull().alias("no_url"), F.coalesce("url", F.lit("")).alias("url"))
    first = cut(light.groupBy("digest").agg(F.min(place).alias("lead")))
    rows = light.join(first, "digest").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("same").cast("int"))))
    leads = (F.col("nth") == 1) & (place == F.col("lead"))
    first_id = F.when(~F.col("lead.no_id"), F.col("lead.id"))
    records = rows.withColumn("revisit", ~leads & (F.col("bytes") >= revisit_bytes)).withColumn("first_id", first_id)

    records.select("page_id", "digest", "bytes", _header(date).alias("header")).write.mode("overwrite").parquet(f"{path}/headers")

    # a payload is written from the row of its first record
    stored = pages.select("page_id", "url", digest.alias("digest"), payload.alias("payload"))
    owners = first.select(F.col("digest").alias("own_digest"), F.col("lead").alias("own_place"))
    chosen = stored.withColumn("place", place).join(owners, F.expr("digest = own_digest AND place = own_place")).select("digest", "payload")
    if not light.filter("same > 1").isEmpty():
        chosen = chosen.dropDuplicates(["digest"])
    chosen.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")
    return path


def _page(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _uri() -> Column:
    uri = F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), _page("page_id")))
    for char in (" ", "\r", "\n", "\t"):
        uri = F.replace(uri, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return F.regexp_replace(uri, r"[\x00-\x1F\x7F]", "%00")


def _header(date: str) -> Column:
    """The bytes before the payload: WARC header lines and, for a response, the HTTP header."""
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    revisit = F.col("revisit")
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    warc = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _page("page_id"), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _uri()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _page("first_id"), F.lit(">"))),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
    )
    return F.encode(F.concat(warc, http), "UTF-8")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: page_id, record_type, refers_to, payload_digest, payload_bytes, header, payload, record.

    Fields are parsed from the header bytes. Each payload's digest is computed anew; one that
    differs from its key stops the job. A column that isn't asked for isn't shuffled.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    found = F.sha2("payload", 256)
    verified = stored.select(
        F.when(found == F.col("digest"), found).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest")))).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        "payload",
    )
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"(?m)^{name}: ([^\r\n]*)", 1)
    number = lambda value: value.try_cast("bigint")
    headers = spark.read.parquet(f"{path}/headers").select(
        number(F.regexp_extract(field("WARC-Record-ID"), r"^<urn:page:(-?\d+)>$", 1)).alias("page_id"),
        field("WARC-Type").alias("record_type"),
        number(F.regexp_extract(field("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1)).alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:(\w+)$", 1).alias("payload_digest"),
        "header",
    )
    joined = headers.join(verified, "payload_digest")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "header", "payload",
        F.concat("header", body, F.lit((CRLF * 2).encode())).alias("record"),
    )


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split(CRLF)
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields | {"version": lines[0]}, rest[: int(fields["Content-Length"])]
