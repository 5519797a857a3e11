"""Content-addressed WARC archive.

Records are kept in two tables in the shared folder: `payloads` holds each payload's bytes once, under its
SHA-256, and `records` holds each record's exact header bytes with that address. A record is rebuilt by
joining the two; whoever reads a payload computes its digest anew, so bytes never pass under a wrong address.

Addresses that very many records share are looked up by broadcast, a thousand of them at most; a payload is so
only where it is small, which all those are that many responses hold.

Defined cases: a null payload is empty; payloads shorter than `least` bytes are always responses; of longer
equal ones the largest id is the response and the others revisit it; null urls give an empty target; line
breaks in a url are percent-encoded; repeated ids each get a record, and of such rows one payload is kept. A row
with a null id has a record without an id field, and revisits where a row with an id holds its payload; where
none does, it is a response. Extra columns are ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import cut, looked_up, map_texts, stored, utf8

LEAST = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Archive:
    """records: id, header, sha256, kind; payloads: sha256, payload, size, and in `uses` the rows that have it."""

    records: DataFrame
    payloads: DataFrame


def _uid(column: Column) -> Column:
    """A record's name: a digest of its id laid out as a UUID."""
    h = F.md5(F.coalesce(column.cast("string"), F.lit("")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def write_archive(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> Archive:
    """Builds both tables. Only digests and ids are grouped; payload bytes move once, to their address."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).alias("id"), F.col(url).alias("url"), body.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    thin = rows.select("id", "url", "sha256", F.hex(F.unhex(F.sha1("payload"))).alias("sha1"), F.octet_length("payload").cast("long").alias("n"))
    # Only payloads that stand twice need a lookup.
    first = cut(thin.where(F.col("n") >= least).groupBy("sha256").agg(F.max("id").alias("holder"), F.count("*").alias("uses")).where("uses > 1"))
    judged = looked_up(thin, first, ["sha256"], "uses", ["id", "url"])
    revisits = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("id"))
    target = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _uid(F.col("id")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.lower("sha1"))),
        F.coalesce(line("X-Page-Id", F.col("id").cast("string")), F.lit("")),
        line("X-Payload-Length", F.col("n").cast("string")),
        F.when(revisits, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), _uid(F.col("holder")), F.lit(">"))), line("X-Refers-To-Page", F.col("holder").cast("string")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisits, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
    )
    records = stored(judged.select("id", "sha256", F.when(revisits, "revisit").otherwise("response").alias("kind"), header.cast("binary").alias("header")), "warc-records")
    # The combine before the shuffle leaves one copy of a payload for each task; bucketed, payloads are not shuffled again on reading.
    payloads = rows.groupBy("sha256").agg(F.first("payload").alias("payload"), F.count("*").alias("uses")).withColumn("size", F.octet_length("payload"))
    payloads = stored(payloads, "warc-payloads", ["sha256"], **{"parquet.compression.codec.zstd.level": "9"})
    return Archive(records, payloads)


def rebuild(archive: Archive) -> DataFrame:
    """id, record: the bytes of every original record. A revisit has no block, so it needs no payload.

    Payloads stay in their buckets, which the headers come to: how often they are used and how long they are stands beside them.
    """
    responses = archive.records.where("kind = 'response'")
    full = looked_up(responses, archive.payloads, ["sha256"], "uses", ["header"], F.col("size") < LEAST, archive.records.count()).drop("size")
    bare = archive.records.where("kind = 'revisit'").withColumn("payload", F.lit(b""))
    return full.unionByName(bare).select("id", "sha256", F.concat("header", F.coalesce("payload", F.lit(b"")), F.lit(b"\r\n\r\n")).alias("record"))


_FIELD = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; tests the version line, the length and the closing lines."""
    if not data.startswith(b"WARC/1.1\r\n"):
        raise ValueError("WARC: no version line")
    end = data.index(b"\r\n\r\n") + 4
    fields = {k.decode(): v.decode() for k, v in _FIELD.findall(data[10 : end - 2])}
    n = int(fields["Content-Length"])
    block = data[end : end + n]
    if len(block) != n or data[end + n :] != b"\r\n\r\n":
        raise ValueError("WARC: wrong length of a record")
    return fields, block


def parse_stream(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """All records of concatenated bytes."""
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        n = int(re.search(rb"Content-Length: (\d+)", data[at:end])[1])
        found.append(parse_record(data[at : end + n + 4]))
        at = end + n + 4
    return found


def read_archive(archive: Archive, key: str = "page_id") -> DataFrame:
    """Rebuilds and parses every record, testing both digests of each payload that a response holds."""
    names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for sha256, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            fields, block = parse_record(data)
            digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
            if kind == "response" and (hashlib.sha256(block).hexdigest() != sha256 or hashlib.sha1(block).hexdigest() != digest):
                raise ValueError("WARC: a payload differs from its digest")
            refers = fields.get("X-Refers-To-Page")
            for column, value in zip(out, (int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None, int(fields["X-Payload-Length"]), digest, kind, None if refers is None else int(refers)), strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names)

    return map_texts(rebuild(archive).select("sha256", "record"), work, f"{key} long, payload_bytes long, payload_digest string, record_type string, refers_to long", "record")
