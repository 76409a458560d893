"""WARC records in a content-addressed archive.

Payload bytes are stored once under their SHA-256, which is checked against the bytes when they are read; the exact header block of
every record is stored separately with that digest. A join of the two gives the original records back. Among records with equal
payloads the one with the largest page_id is the response, the others revisit it; payloads under `least` bytes are always responses.

Defined results: a null html is the empty payload; a null url an empty target; null page_ids count as smallest; rows that repeat
the largest page_id are all responses; an empty table gives empty archives. Extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import new_path, table

#: Records of equal payloads of so many bytes at least become one response and revisits.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def write(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write `path`/payloads (sha256, payload) and `path`/headers (page_id, sha256, header)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    rows.select("sha256", "payload").groupBy("sha256").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")
    small = rows.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n"))
    best = small.groupBy("sha256").agg(F.max("page_id").alias("response_id"))
    told = small.join(best, "sha256")
    revisit = (F.col("n") >= least) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name("response_id")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF),
    )
    told.select("page_id", "sha256", header.alias("header")).write.parquet(f"{path}/headers")


def base32(column: str):
    """Upper-case base32 of a hexadecimal SHA-1: each five hexadecimal digits are four letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    group = lambda i: F.conv(F.substring(column, 5 * i + 1, 5), 16, 10).cast("long")
    letter = lambda g, k: F.substring(alphabet, (F.shiftright(g, 5 * (3 - k)).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
    return F.concat(*[letter(group(i), k) for i in range(8) for k in range(4)])


def _checked(batches):
    for batch in batches:
        keys, n, digests = batch.column(0).to_pylist(), [], []
        for key, payload in zip(keys, batch.column(1), strict=True):
            data = payload.as_buffer() if payload.is_valid else b""
            if hashlib.sha256(data).hexdigest() != key:
                raise ValueError(f"payload of {key} has other bytes than its digest says")
            n.append(len(data))
            digests.append(base64.b32encode(hashlib.sha1(data).digest()).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string())], names=["sha256", "payload_bytes", "payload_digest"])


def payload_facts(spark: SparkSession, path: str) -> DataFrame:
    """sha256, payload_bytes and payload_digest, from the stored bytes, which must fit their key."""
    rows = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    return rows.mapInArrow(_checked, "sha256 string, payload_bytes long, payload_digest string")


def headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_id long, sha256 string, header string").parquet(f"{path}/headers")


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id and the whole original record (bytes): header block, payload unless a revisit, and two line ends."""
    rows = headers(spark, path).join(spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads"), "sha256")
    body = F.when(F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), F.lit(b"")).otherwise(F.col("payload"))
    return rows.select("page_id", F.concat(F.encode("header", "UTF-8"), body, F.lit((CRLF * 2).encode())).alias("record"), "payload")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record, from the header blocks and the stored payloads."""
    field = lambda key, value: F.regexp_extract("header", rf"(?md)^{key}: {value}\r$", 1)
    rows = headers(spark, path).join(payload_facts(spark, path), "sha256")
    refers = field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>")
    own = rows.select(field("WARC-Record-ID", "<urn:page:(-?[0-9]+|none)>").alias("id"), "payload_bytes", "payload_digest", field("WARC-Type", "([a-z]+)").alias("record_type"), refers.alias("refers"), field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("told"))
    same = F.when(F.col("told") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload digest differ")).cast("string"))
    return own.select(F.expr("try_cast(id as bigint)").alias("page_id"), "payload_bytes", same.alias("payload_digest"), "record_type", F.expr("try_cast(nullif(refers, '') as bigint)").alias("refers_to"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path)
