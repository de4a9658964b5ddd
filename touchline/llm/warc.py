"""WARC archives: writer and splittable reader (operator 9).

Writer: one record per page, each a gzip member of its own. Of records with
equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id
is a ``response``; the others are ``revisit`` records that carry no payload and name
its record id, which follows from page and payload, so any WARC reader resolves
them and a rerun writes the same records. Each task writes archives of its own rows into the shared folder,
under a name no other attempt uses, and hands back a manifest row per archive;
only archives in the manifest are read, so files of lost or repeated tasks are
never seen.

Reader: archives are cut into byte ranges, a row each, spread over tasks. A
task looks for the gzip magic from the start of its range, validates each
candidate by inflating it and decoding the WARC header, and owns the records
that start inside its range, reading past the range's end to finish the last
one. Candidates that do not decode (the magic inside compressed data) are
passed over. A task holds one read buffer and one record at a time.

Defined results: null html is the empty payload; a null page_id never is the
smallest; among rows that repeat the smallest page_id all are responses; a
payload whose rows all lack a page_id is a response each time; repeated rows
come back once per row (as records of one id); an empty table gives an empty result; url may be null
(the header is left out); other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, spread, table

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 4 << 20
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 17
#: The revisit profile of the WARC standard and the records' date.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
PAGE_ID = "WARC-Page-Id"
REFERS_TO = "WARC-Refers-To-Page-Id"  # the same reference, by page
RECORDS = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
           "payload binary, archive string, start long")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, payload_digest: str, url: str | None = None) -> str:
    """A record's id, from what it holds: the response of a page and payload is named without a
    URL, so a revisit can name it and reruns write equal records."""
    kind = "response" if url is None else f"revisit of {url}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{page_id}/{payload_digest}')}>"


def record(page_id, url, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member."""
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, payload_digest, str(url) if revisit else None)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{payload_digest}", "Content-Type: text/html"]
    if page_id is not None:
        head.append(f"{PAGE_ID}: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, payload_digest)}",
                 f"{REFERS_TO}: {refers_to}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parsed(whole: bytes) -> dict | None:
    """Headers (lower-case names) and block of an inflated record; None if it is none."""
    if not whole.startswith(b"WARC/1."):
        return None
    head, gap, rest = whole.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    return {"fields": fields, "block": rest[:length]} if len(rest) >= length else None


class Window:
    """Bytes of a file from a moving start on, read as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.at, self.bytes = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        piece = self.file.read(READ_BYTES)
        self.bytes += piece
        return bool(piece)

    def drop(self, n: int) -> None:
        self.bytes = self.bytes[n:]
        self.at += n


def member(window: Window) -> tuple[bytes, int] | None:
    """The inflated gzip member at the window's start and its packed length; None if it is no WARC record.

    The first inflated bytes decide whether the candidate is worth reading on.
    """
    unpacker, out, used = zlib.decompressobj(31), [], 0
    size = 0
    while True:
        try:
            piece = unpacker.decompress(window.bytes[used:])
        except zlib.error:
            return None
        used = len(window.bytes)
        out.append(piece)
        size += len(piece)
        if size >= 7 and not b"".join(out[:8])[:7] == b"WARC/1.":
            return None
        if unpacker.eof:
            return b"".join(out), used - len(unpacker.unused_data)
        if not window.more():
            return None


def records_in(file, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """The records that start in [start, end) of a file, with their places."""
    window = Window(file, start)
    while window.at < end:
        found = window.bytes.find(MAGIC)
        if found < 0:
            window.drop(max(0, len(window.bytes) - len(MAGIC) + 1))
            if not window.more():
                return
            continue
        window.drop(found)
        if window.at >= end:
            return
        whole = member(window)
        read = parsed(whole[0]) if whole else None
        if read is None:
            window.drop(1)
            continue
        yield window.at, read
        window.drop(whole[1])


def written(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``(page_id, url, payload, payload_digest, refers_to)`` rows as archives
    under ``folder``; the manifest ``(path, length, records)`` of whole archives."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path = sink = None
        length = count = 0

        def closed():
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "length": [length], "records": [count]},
                                              pa.schema([("path", pa.string()), ("length", pa.int64()), ("records", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    path, length, count = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                packed = record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"])
                sink.write(packed)
                length, count = length + len(packed), count + 1
                if length >= ARCHIVE_BYTES:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    columns = pages.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return cut(columns.mapInArrow(per_task, "path string, length long, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the manifest's archives, a row each (columns ``RECORDS``)."""
    ranges = manifest.where(F.col("length") > 0).select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("begin"))
    ranges = ranges.select("path", "begin", F.least(F.col("begin") + split_bytes, "length").alias("end"))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, at = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(at) as file:
                    rows, size = [], 0
                    for start, got in records_in(file, row["begin"], row["end"]):
                        rows.append(_row(got, row["path"], start))
                        size += len(got["block"])
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, _schema())
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _schema())

    return spread(ranges, "path", "begin").mapInArrow(per_task, RECORDS)


def _schema() -> pa.Schema:
    return pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                      ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                      ("archive", pa.string()), ("start", pa.int64())])


def _row(got: dict, path: str, start: int) -> dict:
    fields = got["fields"]
    refers = fields.get(REFERS_TO.lower())
    page = fields.get(PAGE_ID.lower())
    return {"page_id": int(page) if page is not None else None, "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"], "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "refers_to": int(refers) if refers else None, "payload": got["block"],
            "archive": path, "start": start}


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, payload_digest, refers_to)``: which page holds the same payload first.

    The first page per payload is a minimum that is combined in the tasks; only
    (digest, first page) pairs meet the pages again, and adaptive execution
    splits a payload that very many pages share.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    firsts = (rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("sha1").alias("of_sha1"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    joined = rows.join(firsts, F.col("sha1") == F.col("of_sha1"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", _base32(F.col("sha1")).alias("payload_digest"), refers.alias("refers_to"))


def _base32(hexed):
    """Upper-case base32 of 40 hex digits: each 5 digits are 20 bits, which are 4 letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    return F.concat(*[F.substring(F.lit(letters), F.shiftright(g, s).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1))
                      for g in groups for s in (15, 10, 5, 0)])


def resolved(records: DataFrame) -> DataFrame:
    """Every record with its payload's length: a revisit's is that of the response it refers to."""
    plain = records.select("page_id", "record_type", "payload_digest", "refers_to",
                           F.octet_length("payload").cast("long").alias("own_bytes"))
    plain = cut(plain, "warc-records")
    responses = plain.where(F.col("record_type") == "response").groupBy(
        F.col("page_id").alias("of_page"), F.col("payload_digest").alias("of_digest")).agg(F.max("own_bytes").alias("full"))
    joined = plain.join(responses, (F.col("refers_to") == F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest")), "left")
    return joined.select("page_id", F.when(F.col("record_type") == "revisit", F.col("full")).otherwise(
        F.col("own_bytes")).alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op9_warc(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    manifest = written(with_references(table(spark, sf_dir, "pages"), min_bytes=0), folder)
    return resolved(read_archives(manifest))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hexed FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hexed) AS first FROM h),
d AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hexed, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest FROM f)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""
