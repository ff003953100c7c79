"""Content-addressed WARC archive.

An archive is two tables. ``payloads`` holds the bytes of each different payload
once, under its SHA-256 (the address) with its length; ``headers`` holds the
exact header block of every record and the address of its payload. Copies are
folded within each task before anything moves, so a payload that a third of
all pages share crosses the network once per task. Both tables are bucketed by
address, so putting records together again is a join that moves no payload.

A ``response`` record is its header block, the payload and two line ends; a
``revisit`` record has no block and names the response it repeats. On reading,
every payload must have the digest that addresses it, or the read fails.

Of records with equal payloads the one with the largest key (then URL) is the
response; payloads under ``least`` bytes are all responses. Defined results: a
null payload counts as empty, a null URL as ``urn:unknown``; null keys rank
lowest and are kept; identical repeated rows are numbered, the first may be
the response, the others revisit it; line ends in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, shared_path

DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NS = uuid.UUID("6f1f5b0e-6f55-4c5c-9d0b-6f6f0d6a5a10")


@dataclass(frozen=True)
class Archive:
    """Names of the two tables."""

    payloads: str
    headers: str

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.payloads), spark.table(self.headers)


def record_id(key: object, url: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NS, f'{key}|{copy}|{url}')}>"


def header_block(kind: str, key: object, url: str, copy: int, sha1: str, n: int, refers: tuple | None) -> bytes:
    """The exact bytes before a record's block. ``refers``: key, URL and copy of
    the response that a revisit repeats."""
    safe = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key, url, copy)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {safe}", f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: text/html; charset=utf-8",
             f"X-Page-Id: {'' if key is None else key}", f"X-Payload-Length: {n}"]
    if refers is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(*refers)}",
                  f"X-Refers-To-Page-Id: {'' if refers[0] is None else refers[0]}"]
    lines.append(f"Content-Length: {n if refers is None else 0}")
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "replace")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    n = int(fields["Content-Length"])
    if not first.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, rest[:n]


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archive(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
                  buckets: int | None = None) -> Archive:
    """Write one record per row of ``df``; ``payload`` is text (as UTF-8) or binary."""
    spark = df.sparkSession
    bounded_batches(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(url), F.lit("urn:unknown")).alias("url"),
                     F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("address", F.sha2("payload", 256))
    name = f"groundtrack_warc_{uuid.uuid4().hex}"
    at = shared_path(spark, "warc")
    archive = Archive(f"{name}_payloads", f"{name}_headers")

    # each different payload once: any of the equal ones, folded in each task first
    (rows.groupBy("address").agg(F.first("payload").alias("payload"))
     .withColumn("n_bytes", F.length("payload").cast("bigint"))
     .write.bucketBy(n, "address").option("path", f"{at}/payloads").format("parquet").saveAsTable(archive.payloads))

    digests = spark.table(archive.payloads).mapInPandas(_digests, "address string, n_bytes bigint, sha1 string")
    records = rows.groupBy("address", "k", "url").agg(F.count("*").alias("n"))
    leaders = records.groupBy("address").agg(F.max(F.struct("k", "url")).alias("leader"))
    told = (records.join(leaders, "address").join(digests, "address")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
            .withColumn("first", F.struct("k", "url").eqNullSafe(F.col("leader")) & (F.col("copy") == 0) | (F.col("n_bytes") < least)))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kind_of = ["response" if f else "revisit" for f in pdf["first"]]
            head = [header_block(t, _id(k), u, c, s, m, None if f else (_id(lk), lu, 0)) for t, k, u, c, s, m, f, lk, lu in zip(
                kind_of, pdf["k"], pdf["url"], pdf["copy"], pdf["sha1"], pdf["n_bytes"], pdf["first"], pdf["lk"], pdf["lu"], strict=True)]
            yield pd.DataFrame({"address": pdf["address"], "record_type": kind_of, "header": head})

    (told.select("address", "k", "url", "copy", "sha1", "n_bytes", "first", F.col("leader.k").alias("lk"), F.col("leader.url").alias("lu"))
     .withColumns({"k": F.col("k").cast("string"), "lk": F.col("lk").cast("string")})
     .mapInPandas(blocks, "address string, record_type string, header binary")
     .write.partitionBy("record_type").option("path", f"{at}/headers").format("parquet").saveAsTable(archive.headers))
    return archive


def _id(value: object) -> object:
    return None if value is None or value != value else value


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of the stored payloads, each checked against its address."""
    for pdf in batches:
        data = [bytes(p) for p in pdf["payload"]]
        for a, p, n in zip(pdf["address"], data, pdf["n_bytes"], strict=True):
            if hashlib.sha256(p).hexdigest() != a or len(p) != n:
                raise ValueError(f"payload does not have the digest {a}")
        yield pd.DataFrame({"address": pdf["address"], "n_bytes": pdf["n_bytes"], "sha1": [_sha1(p) for p in data]})


def records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original records: record_type and the exact bytes of each. A response
    is joined to its payload, bucket by bucket, and checked against its
    address; a revisit has no block."""
    payloads, headers = archive.read(spark)
    end = F.lit(b"\r\n\r\n")
    checked = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have the digest "), F.col("address"))))
    responses = (headers.filter("record_type = 'response'").join(payloads.hint("merge"), "address")
                 .select("record_type", F.concat("header", checked.cast("binary"), end).alias("record")))
    return responses.unionByName(headers.filter("record_type = 'revisit'").select("record_type", F.concat("header", end).alias("record")))


def payload_of(spark: SparkSession, archive: Archive) -> DataFrame:
    """Header and full payload of every record, revisits included."""
    payloads, headers = archive.read(spark)
    return headers.join(payloads, "address").select("record_type", "header", "payload")


def parsed(read: DataFrame) -> DataFrame:
    """Fields of read records: key (as text), url, payload_bytes,
    payload_digest, record_type, refers_to. A response's length and digest come
    from its block, a revisit's from its header."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for raw in pdf["record"]:
                f, block = parse_record(bytes(raw))
                response = f["WARC-Type"] == "response"
                digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                if response and (_sha1(block) != digest or len(block) != int(f["X-Payload-Length"])):
                    raise ValueError(f"record {f['WARC-Record-ID']} does not match its digest")
                out.append((f["X-Page-Id"] or None, f["WARC-Target-URI"], len(block) if response else int(f["X-Payload-Length"]), digest,
                            f["WARC-Type"], f.get("X-Refers-To-Page-Id") or None))
            yield pd.DataFrame(out, columns=["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read.select("record").mapInPandas(
        run, "key string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
