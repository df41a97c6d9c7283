"""WARC archives: written, read, and stripped of equal payloads.

An archive is a folder of gzip files, each a run of records that end in two
line ends.  Spark's text writer makes them, with these line ends between rows,
and its text reader cuts them there again: a gzip file is read by one task, in
order, and the reader puts records together by their ``Content-Length``, so a
payload may hold anything, line ends and whole records too.  No task holds more
than a record beside its batch.

Revisit resolution (:func:`deduplicate`): only headers are shuffled by payload
digest, the first response of a digest is its original, every other record is
joined to it, and a new archive is written with fresh headers: originals whole,
the others as ``revisit`` records that name their original.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast.llm.common import OWN, staged
from cohortcast.operators.joins import BUCKETS, split_hot_join
from cohortcast.session import fresh_path

# ---------------------------------------------------------------------------
# Fixed values of the format.
# ---------------------------------------------------------------------------
VERSION, LINE, END = "WARC/1.1", "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RESPONSE, REVISIT = "response", "revisit"
#: Base-32 digits as ``conv`` writes them, and as RFC 4648 does.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Our own header fields: the row that a record was written for, and its original's.
ROW, REFERS_ROW = "X-Row-Id", "X-Refers-To-Row-Id"

#: Records of a file, so that a lost task reads no more than that again.
FILE_RECORDS = 50_000
#: Copies of a payload that one join task takes at most.
HOT_ROWS = 50_000
#: Characters of a header that none may hold (they would end or start a line).
CONTROL = r"[\x00-\x20\x7F]"

HEADERS = ("record_id string, type string, row long, uri string, date string, digest string, payload_bytes long,"
           " refers_to string, refers_row long")


def digest_of(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: its 160 bits are four times eight digits."""
    hexed = F.sha1(payload.cast("binary"))
    fives = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*fives), DIGITS, BASE32)


def _field(name: str, value: Column) -> Column:
    """A header line; none if the value is null."""
    return F.concat(F.lit(f"{name}: "), value)


def _record(kind: Column, record_id: Column, row: Column, uri: Column, date: Column, digest: Column,
            payload: Column, refers_to: Column, refers_row: Column) -> Column:
    """A record up to its last two line ends.  A revisit keeps the HTTP head
    and loses the payload; its digest stays that of the payload."""
    block = F.concat(F.lit(HTTP_HEAD), F.when(kind == RESPONSE, payload).otherwise(F.lit("")))
    revisit = kind == REVISIT
    head = F.concat_ws(
        LINE, F.lit(VERSION), _field("WARC-Type", kind), _field("WARC-Record-ID", record_id),
        _field("WARC-Target-URI", F.regexp_replace(uri, CONTROL, "%20")), _field("WARC-Date", date),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), _field(ROW, row.cast("string")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _field("WARC-Refers-To", F.when(revisit, refers_to)),
        _field(REFERS_ROW, F.when(revisit, refers_row.cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(END), block)


def _write(records: DataFrame, path: str) -> str:
    """Rows of :func:`_record` as gzip files below ``path``, which must be new."""
    (records.write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))
    return path


def _new_id(run: str) -> Column:
    """A record id: unique in the archive whatever the rows hold."""
    h = F.md5(F.concat(F.lit(run), F.monotonically_increasing_id().cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
                    F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", date: str = "2000-01-01T00:00:00Z") -> str:
    """Writes a ``response`` record for every row of ``pages`` below ``path``.

    * A null payload is empty; a null id or URI has no header field; blanks and
      control characters of a URI become ``%20``.
    * Repeated rows are records of their own.  Further columns are left out,
      whatever their names.
    """
    null = F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    own = pages.select(F.col(id_col).cast("long").alias("row"), F.col(uri_col).cast("string").alias("uri"),
                       payload.alias("payload")).withColumn("record_id", _new_id(uuid.uuid4().hex))
    return _write(own.select(_record(F.lit(RESPONSE), F.col("record_id"), F.col("row"), F.col("uri"), F.lit(date),
                                     digest_of(F.col("payload")), F.col("payload"), null, null).alias("value")), path)


# ---------------------------------------------------------------------------
# Reading.
# ---------------------------------------------------------------------------
def _fields(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "surrogateescape").split(LINE)
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record begins here: {first[:80]!r}")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def records(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of one file, which comes cut at
    every :data:`END`."""
    end, buffer, head, need = END.encode(), bytearray(), None, 0
    for part in parts:
        buffer += part
        buffer += end
        while True:
            if head is None:
                at = buffer.find(end)
                if at <= 0:  # nothing but the line ends that close the file
                    break
                head = _fields(bytes(buffer[:at]))
                need = int(head["content-length"])
                del buffer[:at + len(end)]
            if len(buffer) < need + len(end):
                break
            if buffer[need:need + len(end)] != end:
                raise ValueError(f"record {head.get('warc-record-id')} is longer than its Content-Length says")
            yield head, bytes(buffer[:need])
            del buffer[:need + len(end)]
            head = None
    if head is not None or buffer.strip():
        raise ValueError("the file ends within a record")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(file, its parts) of rows (value, file) that come file by file."""
    rows = ((v.as_buffer().to_pybytes() if v.is_valid else b"", f.as_py())
            for batch in batches for v, f in zip(batch.column(0).cast(pa.binary()), batch.column(1)))
    ahead = next(rows, None)

    def of(file: str) -> Iterator[bytes]:
        nonlocal ahead
        while ahead is not None and ahead[1] == file:
            part = ahead[0]
            ahead = next(rows, None)
            yield part

    while ahead is not None:
        yield ahead[1], of(ahead[1])


def _row(head: dict[str, str], block: bytes) -> tuple[tuple, bytes]:
    kind, said = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
    http, _, payload = block.partition(END.encode())
    size = None
    if kind == RESPONSE:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if said and said != digest:
            raise ValueError(f"record {head.get('warc-record-id')} does not hold the payload of its digest")
        said, size = digest, len(payload)
    number = lambda name: int(head[name]) if name in head else None
    return (head.get("warc-record-id"), kind, number(ROW.lower()), head.get("warc-target-uri"), head.get("warc-date"), said,
            size, head.get("warc-refers-to"), number(REFERS_ROW.lower())), payload if kind == RESPONSE else b""


#: Payload bytes and records that the reader hands on at once.
FLUSH_BYTES, FLUSH_RECORDS = 8 << 20, 10_000
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_NAMES = [c.split()[0] for c in HEADERS.split(",")]


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``(record_id, type, row, uri, date, digest, payload_bytes, refers_to,
    refers_row)`` and, on request, ``payload`` (binary) of the records of type
    response and revisit below ``path``.

    Digest and length of a response are those of the payload that is read; a
    digest that its header contradicts, or a cut record, is an error.  A
    revisit has the digest of its header and no length (see :func:`resolve`).
    """
    rows = spark.read.option("lineSep", END).text(path).select("value", "_metadata.file_path")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies, size = [], [], 0

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*held), _TYPES)] if held else [pa.array([], t) for t in _TYPES]
            return pa.RecordBatch.from_arrays([*columns, *([pa.array(bodies, pa.binary())] if payloads else [])],
                                              [*_NAMES, *(["payload"] if payloads else [])])

        for _, parts in _files(batches):
            for head, block in records(parts):
                if head.get("warc-type") not in (RESPONSE, REVISIT):
                    continue
                row, payload = _row(head, block)
                held.append(row)
                if payloads:
                    bodies.append(payload)
                    size += len(payload)
                if size >= FLUSH_BYTES or len(held) >= FLUSH_RECORDS:
                    yield out()
                    held, bodies, size = [], [], 0
        yield out()

    return rows.mapInArrow(parsed, HEADERS + (", payload binary" if payloads else ""))


# ---------------------------------------------------------------------------
# Revisits.
# ---------------------------------------------------------------------------
def _joined(many: DataFrame, one: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``many`` ⋈ ``one`` on ``key``; ``counts (key, n)`` tells which keys are
    spread over several tasks (rows / HOT_ROWS of them at most)."""
    hot = counts.where(F.col("n") > HOT_ROWS).select(key, F.ceil(F.col("n") / F.lit(HOT_ROWS)).cast("long").alias(BUCKETS))
    return split_hot_join(many, one, key, hot, "record_id")


def originals(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(digest, n, first)`` of the payloads of at least ``min_bytes`` that
    several records have: the response with the smallest row (null rows last),
    of equals that with the smallest record id.  Counted before the shuffle."""
    response = F.col("type") == RESPONSE
    order = F.struct(F.col("row").isNull().alias("late"), "row", "record_id")
    of = headers.where(~response | (F.col("payload_bytes") >= min_bytes)).groupBy("digest")
    return (of.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(response, order)).alias("first"))
            .where((F.col("n") > 1) & F.col("first").isNotNull()))


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(record_id, original, original_row)`` of every record that is to
    revisit another one: all that share its digest, an archive's own revisits
    too."""
    first = staged(originals(headers, min_bytes), "warc-originals")
    one = first.select("digest", F.col("first.record_id").alias("original"), F.col("first.row").alias("original_row"))
    of = headers.where((F.col("type") == REVISIT) | (F.col("payload_bytes") >= min_bytes)).select("record_id", "digest")
    return (_joined(of, one, "digest", first.select("digest", "n"))
            .where(F.col("record_id") != F.col("original")).select("record_id", "original", "original_row"))


def deduplicate(spark: SparkSession, path: str, out: str, min_bytes: int = 0) -> str:
    """Writes the archive ``path`` anew below ``out``: of the records with
    equal payloads of at least ``min_bytes`` the first stays a response, the
    others become revisits of it; smaller payloads are all responses.

    A revisit in ``path`` whose response is not there stays as it is.  Payloads
    move once, to meet the decisions; decisions, not payloads, are hashed.
    """
    headers = staged(read_archive(spark, path), "warc-headers")
    found = revisits(headers, min_bytes)
    old = read_archive(spark, path, payloads=True)
    j = old.join(found.hint("shuffle_hash"), "record_id", "left")
    again = F.col("original").isNotNull()
    fresh = _record(F.when(again, F.lit(REVISIT)).otherwise(F.col("type")), F.col("record_id"), F.col("row"), F.col("uri"), F.col("date"),
                    F.col("digest"), F.col("payload").cast("string"), F.coalesce("original", "refers_to"),
                    F.when(again, F.col("original_row")).otherwise(F.col("refers_row")))
    return _write(j.select(fresh.alias("value")), out)


def resolve(headers: DataFrame) -> DataFrame:
    """The records of an archive, each revisit with the length of the payload
    of the response it names (null where the archive lacks it)."""
    again = headers.where(F.col("type") == REVISIT)
    named = staged(again.where(F.col("refers_to").isNotNull()).groupBy("refers_to").agg(F.count(F.lit(1)).alias("n")), "warc-named")
    one = (headers.where(F.col("type") == RESPONSE).select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias(f"{OWN}bytes"))
           .join(named.select("refers_to"), "refers_to"))
    found = _joined(again, named.join(one, "refers_to", "left").select("refers_to", f"{OWN}bytes"), "refers_to", named)
    lost = again.where(F.col("refers_to").isNull()).withColumn(f"{OWN}bytes", F.lit(None).cast("long"))
    both = found.unionByName(lost).withColumn("payload_bytes", F.col(f"{OWN}bytes")).drop(f"{OWN}bytes")
    return headers.where(F.col("type") == RESPONSE).unionByName(both.select(*headers.columns))


def audit(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as an archive, deduplicates it and reads the result:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    Both archives stay below the shared folder (:func:`write_archive`,
    :func:`deduplicate`, for the cases that rows can be).  An empty table gives
    empty archives.
    """
    spark = pages.sparkSession
    whole = write_archive(pages, fresh_path(spark, "warc-whole"))
    lean = deduplicate(spark, whole, fresh_path(spark, "warc-lean"), min_bytes)
    return resolve(staged(read_archive(spark, lean), "warc-headers")).select(
        F.col("row").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_row").alias("refers_to"))


#: DuckDB twin: digests and first pages straight from the table (base 32 of a
#: SHA-1 by its bits).
ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hexed FROM p),
d AS (
  SELECT page_id, payload_bytes, array_to_string(
           [substr('{BASE32}', 1 + ((('0x' || substr(hexed, 1 + 10 * (i // 8)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER, 1)
            FOR i IN range(0, 32)], '') AS payload_digest
  FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""
