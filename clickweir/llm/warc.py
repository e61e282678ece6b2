"""WARC archives in which a payload is stored once.

Headers (record id, payload digest, payload length) are shuffled by digest; of the records with one
digest the last is the original, and the others become revisit records that refer to it. All records
are then written with fresh headers. Archives are WARC 1.1, one gzip stream per file: each row of a text
file is a record, and the line separator is the end of a record. They are written and read through
Spark's file sources only, in whatever store the folder is in.
"""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import common
from clickweir.sources.session import scratch_path

# Fixed values of the format.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text in UTF-8: 40 hexadecimal digits in eight groups of 20 bits,
    each of which makes four letters."""
    digest = F.sha1(payload.cast("binary"))
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(_ALPHABET), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest``; a NULL html is an empty payload. The url
    is percent-escaped where it would break a header line. Rows with a NULL page_id cannot be referred
    to and are left out."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    return pages.where("page_id IS NOT NULL").select(
        F.col("page_id").cast("long"), url.alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"))


def resolved(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``rows`` with ``refers_to``: the largest page_id of the records of its digest, where that is another
    and the payload has at least ``least_bytes``; else NULL. Originals are found from ids and digests alone,
    combined before they are shuffled. Only those of several records are kept, and stored, so that the
    join with the records has a plain exchange on either side and Spark splits a digest that very many
    records have over many tasks (adaptive skew join)."""
    headers = rows.select("page_id", "payload_digest").where(F.col("payload_bytes") >= least_bytes)
    originals = common.stored(
        headers.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.min("page_id").alias("first"))
        .where("original <> first"), "originals")
    joined = rows.join(originals.drop("first"), "payload_digest", "left")
    referred = (F.col("original") != F.col("page_id")) & (F.col("payload_bytes") >= least_bytes)
    return joined.withColumn("refers_to", F.when(referred, F.col("original"))).drop("original")


def lines(rows: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The text of each record (``page_id, url, payload, payload_bytes, payload_digest, refers_to``). A
    revisit keeps the HTTP headers, with the length of the payload it stands for, and leaves the payload out."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(_CRLF * 2))
    body = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_CRLF}WARC-Record-ID: <{_RECORD}"), F.col("page_id").cast("string"),
        F.lit(f">{_CRLF}WARC-Date: {date}{_CRLF}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{_CRLF}WARC-Refers-To: <{_RECORD}"), F.col("refers_to").cast("string"),
                                 F.lit(f">{_CRLF}WARC-Profile: {_PROFILE}"))).otherwise(F.lit("")),
        F.lit(f"{_CRLF}Content-Type: application/http; msgtype=response{_CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(_CRLF * 2))
    return rows.select(F.concat(header, body).alias("value"))


def write(rows: DataFrame, folder: str, per_file: int = 20_000) -> None:
    """Archives of at most ``per_file`` records each, written as Spark writes: whole files, once."""
    (lines(rows).write.option("lineSep", _CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(folder))


# ---------------------------------------------------------------- reading


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names, and ``version``) and block of each record, by their lengths alone."""
    data, at = memoryview(gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive), 0
    whole = data.obj
    while at < len(data):
        end = whole.index(b"\r\n\r\n", at)
        first, *fields = whole[at:end].decode("utf-8").split(_CRLF)
        head = {"version": first} | {k.strip().lower(): v.strip() for k, v in (f.split(":", 1) for f in fields)}
        start = end + 4
        stop = start + int(head["content-length"])
        if whole[stop: stop + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, bytes(data[start:stop])
        at = stop + 4


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _number(field: str | None) -> int | None:
    return int(field.strip("<>").removeprefix(_RECORD)) if field else None


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives in a folder. Length and digest are those of the full payload: of a
    response computed from what is stored, and checked against its header; of a revisit as its headers
    have them. One file is held by one task at a time; a folder without archives gives no rows."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").schema(schema).load(folder).where(F.col("path").rlike(r"/part-[^/]*$")).select("content")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for archive in batch["content"].tolist():
                out = []
                for head, block in parsed(archive):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                    if head["warc-type"] == "response":
                        if (len(payload), b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                            raise ValueError("a payload is not what its header says")
                    out.append((_number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"],
                                _number(head.get("warc-refers-to")), size, digest, payload if with_payload else None))
                    if len(out) == 2000:
                        yield _frame(out, names)
                        out = []
                yield _frame(out, names)

    return files.mapInPandas(rows, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["refers_to"] = frame["refers_to"].astype("Int64")
    return frame


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages as deduplicated archives in the shared folder and read these back. Repeated page ids
    are records of their own; an empty table gives no rows."""
    folder = scratch_path(pages.sparkSession, "warc")
    write(resolved(records(pages), least_bytes), folder)
    return read(pages.sparkSession, folder)
