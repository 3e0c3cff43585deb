"""WARC archives with revisit records for payloads stored before.

Headers are grouped by payload digest to find the record that keeps a payload; every other record of
that payload becomes a revisit that names it. Tasks pack records, each a gzip member of its own, into archives of bounded
size; Spark's text sink writes an archive as one "line", so that its committer keeps files of lost tasks out. The line
separator is an empty gzip member, which readers pass over.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import lean
from riskweave.session import staged

# Fixed values of the WARC 1.1 and RFC 4648 formats.
EOL = "\r\n"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Compressed bytes after which an archive is closed; it is larger by at most one record. Readers hold one at a time.
ARCHIVE_BYTES = 64 << 20
#: Payload digests that occur more than once are recognised by so many bits first, a table of at most 2 ** 20 numbers.
LOW_BITS = 20
#: What separates the "lines" of the text sink.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
#: Compressed bytes inflated at once.
WINDOW = 1 << 15

HEADERS = (
    "page_id long, url string, record_id string, record_type string, payload_digest string,"
    " refers_to_id string, payload_bytes long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a text's UTF-8 bytes in upper-case base32: four groups of 40 bits, 8 digits each."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(F.concat(*groups), BASE32_HEX, BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with digest, size and, for revisits, the page that keeps the payload and its url.

    Null html counts as an empty payload. Among equal payloads of at least ``min_bytes`` bytes the
    smallest page_id keeps the payload (null ids come last); repeated rows of that page_id are all
    responses, and the first of their urls is named. The minimum is taken per digest before the shuffle, so a
    payload held by a third of the pages costs one row per task. Pages whose digest cannot occur twice pass without a
    shuffle; the others are joined with the headers, a plain join that Spark splits when skewed.
    """
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"digest": base32_sha1(F.col("payload")), "size": F.octet_length("payload").cast("long")})
    low = F.xxhash64("digest").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int")
    first = staged(
        base.where(F.col("size") >= min_bytes).groupBy("digest")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("first_digest"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
                low.alias("low")), "warc-firsts")
    repeated = F.broadcast(first.select(F.col("low").alias("r_low")).distinct())
    plain = base.join(repeated, low == F.col("r_low"), "left_anti").withColumns(
        {"kept_by": F.lit(None).cast("long"), "kept_url": F.lit(None).cast("string")})
    asking = base.join(repeated, low == F.col("r_low"), "left_semi")
    joined = asking.join(first.drop("low"), F.col("digest") == F.col("first_digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return plain.unionAll(joined.withColumns(
        {"kept_by": F.when(revisit, F.col("first_id")), "kept_url": F.when(revisit, F.col("first_url"))}).select(plain.columns))


def _packed(records: DataFrame, info: bytes, archive_bytes: int) -> DataFrame:
    """Archives of the records (a column of text) of each task: (value), one gzip member per record."""

    def pack(batches):
        held, size = [], 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

        for batch in batches:
            for record in batch.column(0).cast(pa.binary()):
                member = gzip.compress(record.as_buffer(), compresslevel=6, mtime=0)
                if not held:
                    held.append(info)
                held.append(member)
                size += len(member)
                if size >= archive_bytes:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    return records.mapInArrow(lean(pack), "value binary")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per page below ``path``: gzip files that begin with a warcinfo record.

    ``date`` is that of the records, by default the time of the call.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = resolved(pages, min_bytes)
    is_revisit = F.col("kept_by").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))

    def target(url: str) -> Column:
        return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.col("size").cast("string"), F.lit(EOL + EOL),
    )
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Target-URI", target("url")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, F.concat(
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            line("WARC-Refers-To", _record_id(F.col("kept_by"), F.col("digest"))),
            line("WARC-Refers-To-Target-URI", target("kept_url")),
            line("WARC-Refers-To-Date", F.lit(date)),
        )).otherwise(F.lit("")),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id").cast("string"))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"),
        line("Content-Length", F.octet_length(F.col("block")).cast("string")),
        F.lit(EOL),
    )
    about = f"software: riskweave{EOL}format: WARC File Format 1.1{EOL}"
    info = EOL.join([
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid5(NAMESPACE_URL, path + date)}>", f"WARC-Date: {date}",
        "Content-Type: application/warc-fields", f"Content-Length: {len(about)}", "", about + EOL + EOL])
    records = rows.withColumns({"record_id": _record_id(F.col("page_id"), F.col("digest")), "block": block}).select(
        F.concat(head, F.col("block"), F.lit(EOL + EOL)).alias("record"))
    (
        _packed(records, gzip.compress(info.encode(), mtime=0), archive_bytes)
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1).text(path)
    )


class _Inflated:
    """Bytes of a gzip file (any number of members), inflated as they are asked for."""

    def __init__(self, data: bytes | memoryview):
        self.data, self.next, self.buffer, self.at = memoryview(data), 0, bytearray(), 0
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            self.next -= len(self.inflate.unused_data)
            self.inflate = zlib.decompressobj(31)
        if self.next >= len(self.data):
            return False
        piece = self.data[self.next : self.next + WINDOW]
        self.next += len(piece)
        del self.buffer[: self.at]
        self.at = 0
        self.buffer += self.inflate.decompress(piece)
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.buffer.find(mark, self.at)) < 0:
            if not self._more():
                return None
        found = bytes(memoryview(self.buffer)[self.at : end])
        self.at = end + len(mark)
        return found

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise ValueError("archive ends inside a record")
        found = bytes(memoryview(self.buffer)[self.at : self.at + n])
        self.at += n
        return found


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split(EOL)
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def _records(content: bytes | memoryview, with_payload: bool) -> Iterator[tuple]:
    stream = _Inflated(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        f = _fields(head)
        if f["warc-type"] == "warcinfo":
            stream.take(int(f["content-length"]) + 4)
            continue
        http, _, payload = stream.take(int(f["content-length"])).partition(b"\r\n\r\n")
        stream.take(4)
        page = f.get("x-page-id")
        yield (
            None if page is None else int(page), f["warc-target-uri"], f["warc-record-id"], f["warc-type"],
            f["warc-payload-digest"].removeprefix("sha1:"), f.get("warc-refers-to"),
            int(_fields(http)["content-length"]), payload if with_payload else None,
        )


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``; payloads only on request."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    types = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [f.split()[0] for f in HEADERS.split(",")]

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in _records(memoryview(content.as_buffer()), with_payload):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(lean(parse), HEADERS)


def with_originals(records: DataFrame) -> DataFrame:
    """Records with ``refers_to``: the page whose response a revisit names (null for responses)."""
    kept = (
        records.where("record_type = 'response'").groupBy(F.col("record_id").alias("kept_id"))
        .agg(F.min("page_id").alias("refers_to"))
    )
    return records.join(kept, F.col("refers_to_id") == F.col("kept_id"), "left").drop("kept_id")
