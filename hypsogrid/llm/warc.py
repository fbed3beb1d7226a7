"""WARC archives with revisits: one response per payload, other captures of it as revisit records.

`write_archive` writes records as gzip files of at most RECORDS_PER_FILE, fewer where the largest payload asks for it,
so that a file fits the value of less than 2 GB in which Spark reads it; `read_archive` parses them by
Content-Length, with size and digest of each payload as read. `deduplicate` reads an archive's headers, shuffles
them by payload digest, resolves each group of equal payloads to its first response, joins the decisions to the
records by place in the archive, and writes a new archive: responses whole, revisits with headers of their own and
no payload. `with_payloads` joins the revisits of an archive to their original responses' payloads.

Edge cases: a NULL payload is empty; payloads below `min_payload_bytes` stay responses; among captures with
one page_id the first in the archive is the response; a NULL page_id comes after all others; NULL url is
written as `urn:unknown`, a line end or white space around a url is left out; revisits of the source stay
revisits, of the first response with their digest, or as they are if there is none; a record id is made of the
page's number and of a hash of its url and payload, so pages that share a number have records of their own, and
only equal rows share one; a payload that does not match its header's digest or size fails the read; an empty
table gives empty archives; other columns are not read. A payload may hold anything, record marks included.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: A file has at most so many records, and at most so many bytes before compression, if it has more than one.
RECORDS_PER_FILE, FILE_BYTES, HEAD_BYTES = 4096, 1 << 30, 4096
CRLF = "\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Spark's Hadoop codecs take the level from this option; HTML gains little from higher ones.
_LEVEL = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

HEADERS = (
    "file string, offset long, record_type string, record_id string, page_id long, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to long"
)


def base32(hexed: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: 40 digits are 8 groups of 20 bits, 4 letters each."""
    letters = lambda v: F.concat(*(
        F.substring(F.lit(_ALPHABET), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)
    ))
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(hexed, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    return F.array_join(F.transform(groups, letters), "")


def _record(kind: str, page_id: Column, url: Column, digest: Column, n_bytes: Column, payload: Column | None, refers_to: Column | None) -> Column:
    """A record without the two line ends that close it; its block is an HTTP head and, for a response, the payload."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n_bytes.cast("string"), F.lit(CRLF * 2))
    more = F.lit("")
    if refers_to is not None:
        more = F.concat(F.lit(f"{CRLF}WARC-Profile: {_PROFILE}{CRLF}WARC-Refers-To: <urn:page-response:"), text(refers_to), F.lit(">"))
    length = F.octet_length(http) + (n_bytes if payload is not None else F.lit(0))
    own = F.hex(F.xxhash64(url, digest))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: <urn:page-{kind}:"), own, F.lit(":"), text(page_id),
        F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce(F.trim(F.regexp_replace(url, r"[\r\n]", "")), F.lit("urn:unknown")),
        F.lit(f"{CRLF}WARC-Date: 2024-01-01T00:00:00Z{CRLF}WARC-Payload-Digest: sha1:"), digest, more,
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), length.cast("string"), F.lit(CRLF * 2),
    )
    return F.concat(head, http, payload) if payload is not None else F.concat(head, http)


def records_per_file(largest: int | None, file_bytes: int = FILE_BYTES) -> int:
    """How many records may share a file if the largest payload has so many bytes."""
    return max(1, min(RECORDS_PER_FILE, file_bytes // ((largest or 0) + HEAD_BYTES)))


def write_archive(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """records: one column `value`. The line separator of the text sink is what closes a record."""
    records.select("value").write.options(lineSep=CRLF * 2, maxRecordsPerFile=per_file, **_LEVEL).text(path)


def write_pages(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> int:
    """Every page as a response record; how many records a file has at most."""
    largest = pages.agg(F.max(F.octet_length(F.coalesce(F.col("html"), F.lit(""))))).first()[0]
    per_file = records_per_file(largest, file_bytes)
    payload = F.coalesce(F.col("html"), F.lit(""))
    made = pages.select("page_id", "url", payload.alias("_payload"))
    made = made.withColumns({"_hex": F.sha1(F.col("_payload")), "_n": F.octet_length("_payload").cast("long")})
    value = _record("response", F.col("page_id"), F.col("url"), base32(F.col("_hex")), F.col("_n"), F.col("_payload"), None)
    write_archive(made.select(value.alias("value")), path, per_file)
    return per_file


class _Stream:
    """Bytes of a gzip file, inflated piece by piece: no more than a record and a piece are held."""

    def __init__(self, packed: bytes, piece: int = 1 << 20):
        self.packed, self.piece, self.at = packed, piece, 0
        self.inflate, self.held, self.offset = zlib.decompressobj(31), bytearray(), 0

    def more(self) -> bool:
        if self.inflate.eof and self.inflate.unused_data:  # the next gzip member
            rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            self.held += self.inflate.decompress(rest)
            return True
        if self.at >= len(self.packed):
            return False
        self.held += self.inflate.decompress(self.packed[self.at : self.at + self.piece])
        self.at += self.piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        searched = 0
        while (k := self.held.find(mark, searched)) < 0:
            searched = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        return self.take(k + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += n
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(CRLF)[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _number(urn: str | None) -> int | None:
    last = (urn or "").strip("<>").rpartition(":")[2]
    return int(last) if last.lstrip("-").isdigit() else None


def parse(file: str, packed: bytes, with_payload: bool) -> Iterator[tuple]:
    """Records of one gzip file, in order."""
    stream = _Stream(packed)
    while True:
        at = stream.offset
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        f = _fields(head)
        block = stream.take(int(f["content-length"]))
        stream.take(4)
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, size = f["warc-payload-digest"].partition(":")[2], int(_fields(http)["content-length"])
        if f["warc-type"] == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
            if found != (digest, size):
                raise ValueError(f"{file}: the payload at {at} is not what its header says: {found}, {digest}, {size}")
        row = (file, at, f["warc-type"], f["warc-record-id"], _number(f["warc-record-id"]), f["warc-target-uri"], digest, size, _number(f.get("warc-refers-to")))
        yield (*row, payload.decode("utf-8")) if with_payload else row


def read_archive(spark: SparkSession, path: str, with_payload: bool = False, batch: int = 512) -> DataFrame:
    """One row per record. Without payloads, only headers leave the parser."""
    schema = HEADERS + (", payload string" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, packed in zip(frame["path"], frame["content"]):
                rows, size = [], 0
                for row in parse(file, packed, with_payload):
                    rows.append(row)
                    size += len(row[-1] or "") if with_payload else 0
                    if len(rows) >= batch or size > 1 << 24:
                        yield _frame(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInPandas(read, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame.from_records(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def resolve(headers: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """file, offset, is_response, first_id: each record's role among those of equal payload."""
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("file"), F.col("offset"))
    original = F.col("record_type") == "response"
    first = headers.where(original & (F.col("payload_bytes") >= min_payload_bytes)).groupBy("payload_digest").agg(F.min(order).alias("_first"))
    joined = headers.select("record_type", "payload_digest", "payload_bytes", "file", "offset", "refers_to").join(first, "payload_digest", "left")
    own = F.col("_first").isNull() | (F.col("payload_bytes") < min_payload_bytes) | (
        (F.col("_first.file") == F.col("file")) & (F.col("_first.offset") == F.col("offset"))
    )
    first_id = F.when(F.col("_first").isNull(), F.col("refers_to")).otherwise(F.col("_first.page_id"))
    return joined.select("file", "offset", (original & own).alias("is_response"), first_id.alias("first_id"))


def deduplicate(spark: SparkSession, source: str, target: str, min_payload_bytes: int = 0, per_file: int | None = None) -> None:
    """Reads the archive at source and writes the one at target; per_file: as for the source, if that is known."""
    headers = read_archive(spark, source)
    per_file = per_file or records_per_file(headers.agg(F.max("payload_bytes")).first()[0])
    roles = resolve(headers, min_payload_bytes)
    whole = read_archive(spark, source, with_payload=True).select("file", "offset", "page_id", "target_uri", "payload_digest", "payload_bytes", "payload")
    joined = whole.join(roles, ["file", "offset"])
    args = (F.col("page_id"), F.col("target_uri"), F.col("payload_digest"), F.col("payload_bytes"))
    value = F.when(F.col("is_response"), _record("response", *args, F.col("payload"), None)).otherwise(
        _record("revisit", *args, None, F.col("first_id"))
    )
    write_archive(joined.select(value.alias("value")), target, per_file)


def with_payloads(records: DataFrame) -> DataFrame:
    """Records read with payloads; a revisit gets the payload of the response with its digest, NULL if there is none."""
    originals = records.where("record_type = 'response'").groupBy("payload_digest").agg(F.first("payload").alias("_payload"))
    payload = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.col("_payload"))
    return records.join(originals, "payload_digest", "left").withColumn("payload", payload).drop("_payload")


def archive_pages(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """Writes pages as an archive, deduplicates it, reads the result back: one row per page."""
    spark = pages.sparkSession
    shared.bounded_batches(spark)
    raw, slim = shared.folder(spark, "warc-raw"), shared.folder(spark, "warc")
    deduplicate(spark, raw, slim, min_payload_bytes, write_pages(pages, raw))
    return read_archive(spark, slim).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


#: SHA-1 in base32: 8 groups of 5 hex digits, 4 letters each.
ORACLE = """with p as (select page_id, coalesce(html, '') as html, coalesce(trim(regexp_replace(url, '[\\r\\n]', '', 'g')), 'urn:unknown') as target_uri from pages),
h as (select *, octet_length(encode(html)) as n, sha1(html) as x, min(page_id) over (partition by html) as first from p),
g as (select *, [cast(concat('0x', x[5 * k + 1 : 5 * k + 5]) as bigint) for k in range(0, 8)] as v from h)
select page_id, n as payload_bytes, array_to_string([array_to_string([('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[((y >> s) & 31) + 1] for s in [15, 10, 5, 0]], '') for y in v], '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to, target_uri from g"""
