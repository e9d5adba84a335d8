"""WARC records in a content-addressed archive.

Payload bytes are stored once under their SHA-256, compressed; the exact
header block of every record is stored apart; original records come back
through joins of the two, and each payload is verified against its address and
against the digest in the record that names it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlens.llm.common import bounded_batches, table, written
from govlens.session import shared_path

CRLF = "\r\n"
#: The date that goes into each record, unless the caller gives another: results don't depend on the clock.
RECORD_DATE = "1970-01-01T00:00:00Z"

DIGESTS = T.StructType().add("sha256", T.BinaryType()).add("sha1", T.StringType()).add("n_bytes", T.LongType())
PARSED = T.StructType().add("type", T.StringType()).add("id", T.StringType()).add("refers_to", T.StringType()) \
    .add("digest", T.StringType()).add("n_bytes", T.LongType()).add("sound", T.BooleanType())


def _base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@F.pandas_udf(DIGESTS)
def _digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([(hashlib.sha256(b).digest(), _base32_sha1(b), len(b)) for b in map(bytes, s)],
                           columns=["sha256", "sha1", "n_bytes"])


@F.pandas_udf(T.BinaryType())
def _pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    c = zstandard.ZstdCompressor(level=3)
    for s in batches:
        yield pd.Series([c.compress(bytes(b)) for b in s], dtype=object)


@F.pandas_udf(T.BinaryType())
def _unpack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    d = zstandard.ZstdDecompressor()
    for s in batches:
        yield pd.Series([None if b is None else d.decompress(bytes(b)) for b in s], dtype=object)


def _line(name: str, value: Column) -> Column:
    """A header line; line breaks inside a value are percent-encoded, so a value can't add headers."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF))).otherwise("")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, date: str = RECORD_DATE) -> None:
    """Write ``payloads/`` (sha256, owner, packed bytes) and ``records/`` (header block, address) under ``path``.

    Of records with equal payloads of ``min_bytes`` bytes or more, the one with
    the largest id is the response and the others are revisits of it; smaller
    ones are all responses.  A null payload is an empty one.  Rows that tie for
    the largest id (repeated rows) are all responses.  A null id loses against
    any other, and is a response if all ids of the group are null; its record
    is named "none".  A null url gives no target line.  An empty table gives an
    empty archive.

    Copies are reduced before the shuffle that gathers a payload's group, so a
    payload that a third of all pages share is moved once per map task.
    """
    bounded_batches(pages.sparkSession)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    at = src.withColumn("d", _digests("payload")).select("page_id", "url", "d.*", "payload")
    # the packed bytes are the same for all of a group; an id of null is below all others
    at.select("page_id", "sha256", "n_bytes", _pack("payload").alias("packed")) \
        .groupBy("sha256", "n_bytes").agg(F.max("page_id").alias("owner"), F.first("packed").alias("packed")) \
        .write.mode("overwrite").parquet(f"{path}/payloads")
    owners = at.sparkSession.read.parquet(f"{path}/payloads").select("sha256", "owner")
    rec = at.drop("payload").join(owners, "sha256")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.col("owner").eqNullSafe(F.col("page_id"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("owner")))),
        _line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))),
        F.lit(CRLF))
    rec.select("page_id", F.encode(header, "UTF-8").alias("header"), "sha256", (~revisit).alias("has_body")) \
        .write.mode("overwrite").parquet(f"{path}/records")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every original record, whole: ``page_id, record`` (binary: header block, body, closing line breaks)."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select("sha256", "packed")
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    full = records.where("has_body").join(payloads, "sha256") \
        .select("page_id", F.concat("header", _unpack("packed"), end).alias("record"), "sha256")
    bare = records.where("not has_body").select("page_id", F.concat("header", end).alias("record"), "sha256")
    return full.unionByName(bare)


def parse_record(record: bytes) -> dict:
    """The header fields and the body of one record; raises if the lengths don't fit."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split(CRLF)
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is not its Content-Length")
    return fields | {"body": rest[:n]}


@F.pandas_udf(PARSED)
def _parsed(records: pd.Series, addresses: pd.Series) -> pd.DataFrame:
    out = []
    for r, address in zip(records, addresses, strict=True):
        f = parse_record(bytes(r))
        body, digest = f["body"], f["WARC-Payload-Digest"].removeprefix("sha1:")
        sound = f["WARC-Type"] == "revisit" or \
            (hashlib.sha256(body).digest() == bytes(address) and _base32_sha1(body) == digest)
        out.append((f["WARC-Type"], f["WARC-Record-ID"], f.get("WARC-Refers-To"), digest, len(body), sound))
    return pd.DataFrame(out, columns=["type", "id", "refers_to", "digest", "n_bytes", "sound"])


def resolve(spark: SparkSession, path: str) -> DataFrame:
    """The archive read back: a row per record, with the digest and length of the full payload.

    Bodies are verified against address and digest; a record that doesn't fit,
    or a revisit whose response is missing or has another digest, fails the job.
    """
    # payloads are read, unpacked and verified once; what revisits and responses are joined by is narrow
    rec = written(read_records(spark, path).withColumn("p", _parsed("record", "sha256")).select("page_id", "p.*"), "warc-parsed")
    rec = rec.withColumn("checked", F.when(~F.col("sound"), F.raise_error(
        F.concat(F.lit("damaged record "), "id"))).otherwise(F.lit(True).cast("boolean")))
    ids = records_id_type(spark, path)
    page = F.nullif(F.regexp_extract("refers_to", "<urn:page:(.*)>", 1), F.lit("none")).cast(ids)
    full = rec.where("type = 'response'").where("checked").select(
        "page_id", "n_bytes", "digest", F.lit("response").alias("type"), F.lit(None).cast(ids).alias("refers_to"))
    # responses that tie for an id and a digest are equal
    of = full.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("n_bytes").alias("n_bytes"))
    got = rec.where("type = 'revisit'").select("page_id", "digest", page.alias("refers_to")) \
        .join(of, ["refers_to", "digest"], "left")
    n = F.when(F.col("n_bytes").isNull(), F.raise_error(F.lit("a revisit without its response")).cast("long")) \
        .otherwise(F.col("n_bytes"))
    return full.unionByName(got.select("page_id", n.alias("n_bytes"), "digest", F.lit("revisit").alias("type"), "refers_to"))


def records_id_type(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/records").schema["page_id"].dataType


def op6(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return resolve(spark, path).select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS owner FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM d
"""
