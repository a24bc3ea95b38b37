"""Web archives (WARC 1.1): writing with revisits and segments, reading and reassembly.

Writing.  Every page becomes a record.  Of pages with equal payloads of ``REVISIT_BYTES`` or more
that with the smallest id is a response, the others revisit it and carry no payload.  Payloads go
out in chunked transfer framing; a block longer than ``SEGMENT_CHARS`` is cut into segments, the
first of which is the response and the others continuation records that name its identifier.
Records are text with Spark's text writer, whose line separator is what ends a record, so
archives are committed like any other output; they are compressed with gzip.

Reading.  Archives are read by Spark (any store) and parsed record by record, by the lengths the
headers state.  Segments are grouped by the identifier of their origin, ordered by number, and
accepted if the numbers are complete and the total length is the stated one.  Then the transfer
framing is decoded; for records that are no segments in the parser itself.

* Only digests are shuffled to find equal payloads, pre-aggregated, so many copies are no load.
  The digests that occur twice are joined to the pages: broadcast up to ``BROADCAST_DIGESTS``
  (checked), shuffled beyond.
* Pages are written by the tasks that read them.
* A group of segments is one record, so it is as long as one page at most.
* An archive file holds ``FILE_RECORDS`` records at most.  A worker holds a batch of compressed
  files (64 MB, or one larger file) and decompresses one of them, record by record.

NULL pages have an empty payload.  A NULL id is larger than all others.  Rows with the same id
and payload are all responses, and equal rows have equal records.  URLs lose white space and
control characters.  An empty table makes an empty archive.  Incomplete records are returned with
``complete`` false and a NULL payload: those cut off (also by a broken gzip stream, which ends the
file), without a length, with broken framing or with missing segments.  What stands between records
is skipped up to the next line that begins one.
"""

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from siltline.llm.tables import side, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

REVISIT_BYTES = 100
CHUNK_CHARS = 4096
SEGMENT_CHARS = 16384
FILE_RECORDS = 4096
BROADCAST_DIGESTS = 200_000
PAGE_HEADER = "X-Page-Id"
DATE = "2026-01-01T00:00:00Z"

GIVEN_ON = 8 << 20  # bytes of blocks that a worker gives on together

RECORD = (
    "record_id string, type string, page_id string, uri string, digest string, "
    "origin string, segment int, total bigint, block binary"
)
READ = f"{RECORD}, bytes bigint, read string"


def _cut(text: Column, size: int) -> Column:
    """Pieces of ``size`` characters; linear in the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def chunked(text: Column) -> Column:
    """Chunked transfer framing of a text in UTF-8."""
    framed = F.transform(
        _cut(text, CHUNK_CHARS),
        lambda c: F.concat(F.lower(F.hex(F.octet_length(c).cast("bigint"))), F.lit("\r\n"), c, F.lit("\r\n")),
    )
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _identifier(name: Column) -> Column:
    return F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(record): the text of each record without the separator that ends it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    df = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    df = df.withColumn("digest", F.sha2(F.encode("payload", "UTF-8"), 256)).withColumn("bytes", F.octet_length("payload"))
    long = df.where(F.col("bytes") >= REVISIT_BYTES).select("id", "digest")
    first = long.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    df = df.join(side(first.select("digest", "first"), "repeated-digests", F.lit(1), BROADCAST_DIGESTS), "digest", "left")
    df = df.withColumn("revisit", F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
    # Derived from the row, so that a task that runs again makes the same records.
    df = df.withColumn("rid", _identifier(F.concat_ws("|", "digest", F.col("id").cast("string"), "url")))
    block = F.concat(F.lit(HTTP), F.when(F.col("revisit"), F.lit("")).otherwise(chunked(F.col("payload"))))
    df = df.withColumn("block", block).withColumn("total", F.octet_length("block"))
    df = df.withColumn("segments", _cut(F.col("block"), SEGMENT_CHARS)).withColumn("n", F.size("segments"))
    df = df.select("id", "url", "digest", "revisit", "first", "rid", "total", "n", F.posexplode("segments").alias("k", "segment"))

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        shown = value.isNotNull() if when is None else value.isNotNull() & when
        return F.when(shown, text).otherwise("")

    k, cut = F.col("k"), F.col("n") > 1
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "")
    kind = F.when(k > 0, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    own = F.when(k == 0, F.col("rid")).otherwise(_identifier(F.concat_ws("|", "rid", k.cast("string"))))
    last = k == F.col("n") - 1
    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", uri),
        line(PAGE_HEADER, F.col("id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"), k == 0),
        line("WARC-Profile", F.lit(PROFILE), F.col("revisit") & (k == 0)),
        line("WARC-Segment-Number", (k + 1).cast("string"), cut),
        line("WARC-Segment-Origin-ID", F.col("rid"), k > 0),
        line("WARC-Segment-Total-Length", F.col("total").cast("string"), cut & last),
        line("Content-Type", F.lit("application/http; msgtype=response"), k == 0),
        line("Content-Length", F.octet_length("segment").cast("string")),
        F.lit("\r\n"),
        F.col("segment"),
    )
    return df.select(record.alias("record"))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes archives to a folder; a task writes what it reads, in files of ``FILE_RECORDS``."""
    out = records(pages, page_id, url, html)
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


class _Archive:
    """A stream that ends where it can no longer be read."""

    def __init__(self, content: bytes):
        plain = io.BytesIO(content)
        self.stream = gzip.GzipFile(fileobj=plain) if content[:2] == b"\x1f\x8b" else plain

    def _try(self, read, *args) -> bytes:
        try:
            return read(*args)
        except (EOFError, OSError, zlib.error):
            return b""

    def readline(self) -> bytes:
        return self._try(self.stream.readline)

    def read(self, size: int) -> bytes:
        return self._try(self.stream.read, size)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def parse(stream) -> Iterator[tuple]:
    """Rows of ``RECORD`` for the records of an archive; the block is NULL where the record is cut
    off or states no length.  What stands between records is skipped."""
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            continue
        head = {}
        for line in iter(stream.readline, b""):
            line = line.rstrip(b"\r\n")
            if not line:
                break
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = _number(head.get("content-length"))
        block = stream.read(length) if length is not None else None
        if block is not None and len(block) < length:
            block = None
        yield (
            head.get("warc-record-id"), head.get("warc-type"), head.get(PAGE_HEADER.lower()), head.get("warc-target-uri"),
            (head.get("warc-payload-digest") or "").rpartition(":")[2] or None, head.get("warc-segment-origin-id"),
            _number(head.get("warc-segment-number")), _number(head.get("warc-segment-total-length")), block,
        )


def _digested(row: tuple) -> tuple:
    """A row of ``READ``: a record that is no segment gives length and digest of its payload, not the block."""
    *head, segment, total, block = row
    if segment is not None:
        return *row, None, None
    payload = None if block is None else _body(block)
    if payload is None:
        return *head, segment, total, None, None, None
    return *head, segment, total, None, len(payload), hashlib.sha256(payload).hexdigest()


def _parsed(columns: str, shown=lambda row: row):
    """Function for mapInArrow: from the contents of archives to rows, a few MB at a time."""
    names = [c.split()[0] for c in columns.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for content in some.column(0):
                rows, size = [], 0
                for row in map(shown, parse(_Archive(content.as_py()))):
                    rows.append(row)
                    size += 256 + len(row[8] or b"")
                    if size >= GIVEN_ON:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, with the columns of ``RECORD``."""
    return _contents(spark, path).mapInArrow(_parsed(RECORD), RECORD)


@F.pandas_udf(BinaryType())
def payload_of(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The body of an HTTP message given in parts; NULL if its framing is broken."""
    for many in blocks:
        yield pd.Series([_body(b"".join(parts)) if parts is not None else None for parts in many], dtype=object)


def _body(message: bytes) -> bytes | None:
    head, found, body = message.partition(b"\r\n\r\n")
    if not found:
        return None
    if b"transfer-encoding: chunked" not in head.lower() or not body:
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or end + 2 + size > len(body):
            return None
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def reassemble(found: DataFrame) -> DataFrame:
    """(record_id, type, page_id, uri, digest, payload, complete) of whole records."""
    whole = found.where("segment is null").select(
        "record_id", "type", "page_id", "uri", "digest", F.array("block").alias("parts"),
        F.col("block").isNotNull().alias("complete"),
    )
    cut = found.where("segment is not null").withColumn("key", F.coalesce("origin", "record_id"))
    is_first = F.col("segment") == 1
    named = ["record_id", "type", "page_id", "uri", "digest"]
    joined = cut.groupBy("key").agg(
        *[F.max(F.when(is_first, F.col(c))).alias(c) for c in named],
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("all"),
        F.sum(is_first.cast("int")).cast("int").alias("copies"),
        F.max("total").alias("total"),
    )
    numbers = F.transform("all", lambda s: s["segment"])
    length = F.aggregate("all", F.lit(0).cast("bigint"), lambda n, s: n + F.octet_length(s["block"]))
    complete = (numbers == F.sequence(F.lit(1), F.greatest(F.size("all"), F.lit(1)))) & F.coalesce(length == F.col("total"), F.lit(False))
    parts = F.transform("all", lambda s: s["block"])
    # Equal rows have equal records: as many as there are first segments.
    copies = F.explode(F.array_repeat(F.lit(0), F.greatest("copies", F.lit(1)))).alias("copy")
    joined = joined.select(*named, parts.alias("parts"), complete.alias("complete"), copies).drop("copy")
    df = whole.unionByName(joined)
    df = df.withColumn("payload", payload_of(F.when(F.col("complete"), F.col("parts"))))
    return df.select(*named, "payload", (F.col("complete") & F.col("payload").isNotNull()).alias("complete"))


def read_pages(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, uri, payload_bytes, payload_digest, record_type, refers_to, complete) of each page.

    Digests and lengths are taken from the payloads as read; a revisit has those of the response
    with its digest, which is the one with the smallest id.  Archives are read once: what is no
    segment leaves the parser as length and digest, segments go on to be put together.
    """
    rows = stored(_contents(spark, path).mapInArrow(_parsed(READ, _digested), READ), "archive-records")
    told = ["page_id", "uri", "type", "digest", "complete", "bytes", "read"]
    own = rows.where("segment IS NULL").withColumn("complete", F.col("read").isNotNull()).select(told)
    joined = reassemble(rows.where("segment IS NOT NULL").drop("bytes", "read"))
    joined = joined.withColumns({"bytes": F.octet_length("payload").cast("bigint"), "read": F.sha2("payload", 256)})
    df = own.unionByName(joined.select(told)).where(F.col("type").isin("response", "revisit"))
    df = df.withColumn("page_id", F.col("page_id").cast(id_type))
    df = stored(df, "archive-pages")
    revisits = df.where("type = 'revisit'")
    wanted = revisits.select(F.col("digest").alias("read")).distinct()
    held = df.where("type = 'response'").join(wanted, "read").groupBy("read").agg(
        F.min("page_id").alias("refers_to"), F.max("bytes").alias("held_bytes")
    )
    seen = revisits.drop("read", "bytes").join(held.withColumnRenamed("read", "held"), F.col("digest") == F.col("held"), "left")
    seen = seen.select(
        "page_id", "uri", F.col("held_bytes").alias("payload_bytes"), F.col("held").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to", (F.col("complete") & F.col("held").isNotNull()).alias("complete"),
    )
    own = df.where("type = 'response'").select(
        "page_id", "uri", F.col("bytes").alias("payload_bytes"), F.col("read").alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast(id_type).alias("refers_to"), "complete",
    )
    return own.unionByName(seen)
