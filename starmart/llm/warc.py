"""WARC archives whose repeated payloads are revisit records.

Only headers (id, digest, length) are shuffled, by payload digest, to find the original of each
group of equal payloads; groups are aggregated with partial results, so a payload that very many
pages share is no burden. Payloads stay where they are read: the digests that occur more than once
go back to the pages, each with its original. Every record is a gzip member of its own, as readers
expect, closed by an empty member. Spark's text writer commits them with that empty member as line
end, and its reader cuts files there again, so archives may be of any size: a task reads a split,
and a row is a record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import BROADCAST_IDS, by_value, scratch, written

by_value(__name__)

VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
# An empty gzip member. Compressed text cannot hold it: its first two bytes are no UTF-8, and in
# a compressed stream 20 given bytes do not occur by chance.
CLOSING = gzip.compress(b"", mtime=0)
CUT = {"lineSep": CLOSING.decode("latin-1"), "encoding": "ISO-8859-1"}
LEVEL = 6
BATCH_BYTES = 8 << 20

RECORDS = (
    "record_id string, record_type string, page_id bigint, uri string, refers_to_record string, "
    "claimed_digest string, payload_digest string, payload_bytes bigint, payload binary"
)


def base32(digest: Column) -> Column:
    """Upper-case base32 of 160 bits in hexadecimal: 8 groups of 20, 4 digits each."""
    digits = F.concat(*[
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ])
    return F.translate(
        digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def record_id(page_id: Column, digest: Column) -> Column:
    """A name-based id: the same page and payload have the same one in every build."""
    name = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    ends, at = [], 1
    for size in (8, 4, 4, 4, 12):
        ends.append(F.substring(name, at, size))
        at += size
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *ends), F.lit(">"))


def header_value(value: Column) -> Column:
    """Control characters would end the header line: they are percent-encoded."""
    for code in (0, 9, 10, 11, 12, 13):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def plan_records(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """pages (page_id, url, html) with what their records say: digest, type, original.

    Among payloads of at least `least` bytes that are equal, the smallest page_id is the
    response. Rows that repeat it are responses too; a NULL page_id refers to the smallest known
    one, or is a response where there is none. The digests that repeat are written under folder;
    they are broadcast if they were counted to be at most BROADCAST_IDS.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumns({
        "payload_bytes": F.octet_length("html").cast("long"),
        "digest": F.unhex(F.sha1(F.encode("html", "UTF-8"))),
    })
    headers = rows.where(F.col("payload_bytes") >= least).select("page_id", "digest", "payload_bytes")
    repeated = headers.groupBy("digest", "payload_bytes").agg(
        F.min("page_id").alias("original"), F.count(F.lit(1)).alias("copies")
    ).where("copies > 1 and original is not null").drop("copies")
    repeated = written(repeated, f"{folder}/repeated")
    if repeated.count() <= BROADCAST_IDS:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, ["digest", "payload_bytes"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.select(
        "page_id", "url", "html", "payload_bytes", base32(F.hex("digest")).alias("payload_digest"),
        F.when(revisit, F.col("original")).alias("refers_to"),
    )


def record_text(date: str = DATE) -> Column:
    """A whole record."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("payload_digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), header_value(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "),
                                 record_id(F.col("refers_to"), F.col("payload_digest")))),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    # concat_ws leaves out the lines that are NULL: no URL, no page id, no original.
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block, F.lit(END))


def compress_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as gzip members, about BATCH_BYTES at a time."""
    members, size = [], 0
    for batch in batches:
        for text in batch.column("record"):
            members.append(gzip.compress(text.as_buffer(), LEVEL, mtime=0))
            size += len(members[-1])
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])
                members, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = DATE) -> DataFrame:
    """Write one record per row of pages (page_id, url, html) under folder/archives.

    date goes into the records' WARC-Date.
    """
    records = plan_records(pages, folder, least).select(record_text(date).alias("record"))
    members = records.mapInArrow(compress_batches, "member binary")
    members.select(F.col("member").cast("string")).write.options(**CUT).text(f"{folder}/archives")
    return read_archives(pages.sparkSession, f"{folder}/archives")


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers, with lower-case names, and block of every record in an archive."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        first, *lines = bytes(view[at:stop]).decode("utf-8").split("\r\n")
        if first != VERSION:
            raise ValueError(f"no {VERSION} record at byte {at}")
        headers = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        start = stop + 4
        end = start + int(headers["content-length"])
        if bytes(view[end : end + 4]) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its header says")
        yield headers, view[start:end]
        at = end + 4


def read_records(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.binary()]
    rows, size = [], 0
    for batch in batches:
        for member in batch.column("member"):
            for headers, block in parse(gzip.decompress(member.as_buffer())):
                body = bytes(block).partition(b"\r\n\r\n")[2]
                whole = headers["warc-type"] == "response"
                digest = base64.b32encode(hashlib.sha1(body).digest()).decode() if whole else None
                page = headers.get("x-page-id")
                rows.append((
                    headers["warc-record-id"], headers["warc-type"], None if page is None else int(page),
                    headers.get("warc-target-uri"), headers.get("warc-refers-to"),
                    headers["warc-payload-digest"].removeprefix("sha1:"), digest,
                    len(body) if whole else None, body if whole and payloads else None,
                ))
                size += len(block) if payloads else 1000
            if size > BATCH_BYTES:
                yield _batch(rows, names, kinds)
                rows, size = [], 0
    yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives under path, which write_archives() has written."""
    members = spark.read.options(**CUT).text(path).select(F.col("value").cast("binary").alias("member"))
    return members.mapInArrow(lambda it: read_records(it, payloads), RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload facts of the response that a revisit refers to.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). A record whose payload does
    not have the digest its header states, or a revisit without its original, has NULL facts.
    """
    whole = records.where("record_type = 'response'")
    sound = F.col("payload_digest") == F.col("claimed_digest")
    responses = whole.select(
        "page_id",
        F.when(sound, F.col("payload_bytes")).alias("payload_bytes"),
        F.when(sound, F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    originals = whole.where(sound).groupBy("record_id").agg(
        F.first("page_id").alias("original"), F.first("payload_bytes").alias("bytes"),
        F.first("payload_digest").alias("digest"),
    )
    revisits = records.where("record_type = 'revisit'").select(
        "page_id", "claimed_digest", "record_type", F.col("refers_to_record").alias("record_id")
    )
    found = revisits.join(originals, "record_id", "left")
    agreed = F.col("digest") == F.col("claimed_digest")
    return responses.unionByName(found.select(
        "page_id",
        F.when(agreed, F.col("bytes")).alias("payload_bytes"),
        F.when(agreed, F.col("digest")).alias("payload_digest"),
        "record_type",
        F.col("original").alias("refers_to"),
    ))


def archived_pages(pages: DataFrame, least: int = 0, date: str = DATE) -> DataFrame:
    """Write pages (page_id, url, html) to archives, read them back and resolve the revisits.

    One row per page: page_id, payload_bytes, payload_digest (bare base32 SHA-1, of the full
    payload also for revisits), record_type, refers_to.

    Defined cases: a NULL html is the empty payload. Equal payloads of at least `least` bytes are
    stored once, with the smallest page_id; repeated rows of that page are responses too. A NULL
    page_id refers to the smallest known id with its payload, or is a response. A NULL url has no
    header. No rows give no rows. Other columns are not read.
    """
    folder = scratch(pages.sparkSession, "warc")
    records = write_archives(pages, folder, least, date)
    return resolve(written(records.drop("payload"), f"{folder}/records"))
