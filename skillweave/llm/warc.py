"""WARC archives of pages, and a reader that splits compressed archives (operator 5).

Each record is a gzip member of its own. A reader task owns the records whose member starts inside its byte range: it looks
for the gzip magic, takes a candidate as a member if its first bytes inflate to a WARC header, and from there on
follows the members until one starts beyond its range. Nobody has to read an archive from its start.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import join_groups, salted
from skillweave.session import shared_root

MIN_REVISIT_BYTES = 1000
RANGE_BYTES = 8 << 20
_MAGIC = b"\x1f\x8b\x08"
_BLOCK = 1 << 20
_STEP = 1 << 14
_START = b"WARC/1."
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, uri string, payload binary, payload_digest string, payload_bytes long, refers_to string, page_id long, refers_page long"


def plan_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, record_type, refers_to``: of equal payloads the row with the largest id is the response.

    Payloads are equal when SHA-256 and length are. Of rows that repeat that id one is the response. Null ids come last.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("salt", salted(F.struct("page_id", "url")))
    long_rows, short = rows.where(F.octet_length("payload") >= min_bytes), rows.where(F.octet_length("payload") < min_bytes)
    groups = long_rows.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"))
    met = join_groups(long_rows, groups, "digest")
    response = F.struct("page_id", "url").eqNullSafe(F.col("first"))
    cols = ["page_id", "url", "payload"]
    planned = met.select(*cols, F.when(response, "response").otherwise("revisit").alias("record_type"), F.when(~response, F.col("first.page_id")).alias("refers_to"))
    return planned.unionByName(short.select(*cols, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit holds the headers only; its digest and length are those of the full payload."""
    body = payload if record_type == "response" else b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    clean = "".join(c if c.isprintable() and c != " " else "%%%02X" % ord(c) for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}", f"X-Payload-Length: {len(payload)}",
    ]
    head += [] if page_id is None else [f"X-Page-ID: {page_id}"]
    if record_type == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"] + ([] if refers_to is None else [f"X-Refers-To-Page: {refers_to}"])
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def _path(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_archives(planned: DataFrame, uri: str) -> list[tuple[str, int]]:
    """One archive per task below ``uri``, in a folder all executors reach; names and sizes of the archives.

    A task writes under a name of its attempt and renames at the end, so one that is repeated leaves one archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, folder = _path(uri)
        fs.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():06d}.warc.gz"
        draft, size = f"{folder}/.{name}-{context.taskAttemptId()}", 0
        with fs.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    size += out.write(record(*row))
        fs.move(draft, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())], names=["name", "size"])

    order = ["page_id", "url", "payload", "record_type", "refers_to"]
    done = planned.select(*order).mapInArrow(run, "name string, size long")
    return [(f"{uri.rstrip('/')}/{r.name}", r.size) for r in done.collect()]


class _Source:
    """Bytes of one archive; a block read ahead serves the requests that lie inside it."""

    def __init__(self, uri: str):
        fs, path = _path(uri)
        self.file = fs.open_input_file(path)
        self.held, self.at = b"", 0

    def block(self, at: int, size: int = _STEP) -> bytes:
        """At most ``size`` bytes from ``at``; none beyond the end."""
        if not (self.at <= at and at + size <= self.at + len(self.held)):
            self.file.seek(at)
            self.held, self.at = self.file.read(max(size, _BLOCK)), at
        return self.held[at - self.at : at - self.at + size]


def _is_member(source: _Source, at: int) -> bool:
    """Whether a WARC record inflates from here; needs a few bytes only."""
    try:
        return zlib.decompressobj(31).decompress(source.block(at, 4096), 64).startswith(_START)
    except zlib.error:
        return False


def first_member(source: _Source, start: int, end: int) -> int | None:
    """The first place in [start, end) where a member starts."""
    at = start
    while at < end:
        data = source.block(at, min(_BLOCK, end - at) + len(_MAGIC) - 1)
        found = data.find(_MAGIC)
        while found >= 0:
            if at + found < end and _is_member(source, at + found):
                return at + found
            found = data.find(_MAGIC, found + 1)
        at += _BLOCK
    return None


def members(source: _Source, start: int, end: int) -> Iterator[bytes]:
    """The inflated members that start in [start, end); garbage between members is skipped by looking for the next."""
    at = first_member(source, start, end)
    while at is not None and at < end:
        inflate, parts, pos = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof:
                data = source.block(pos)
                if not data:
                    break
                parts.append(inflate.decompress(data))
                pos += len(data)
        except zlib.error:
            at = first_member(source, at + 1, end)
            continue
        if inflate.eof:
            yield b"".join(parts)
        nxt = pos - len(inflate.unused_data)
        at = nxt if nxt < end and _is_member(source, nxt) else first_member(source, max(nxt, at + 1), end)


def parse(raw: bytes) -> tuple:
    """A record as in ``RECORD``; the payload is what follows the HTTP headers, none for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields["WARC-Type"]
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
    else:
        digest, size = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(fields["X-Payload-Length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return fields["WARC-Record-ID"], kind, fields["WARC-Target-URI"], payload if kind == "response" else None, digest, size, fields.get("WARC-Refers-To"), number("X-Page-ID"), number("X-Refers-To-Page")


def read_archives(spark: SparkSession, archives: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of archives (uri, size), one task for each byte range of ``range_bytes``."""
    ranges = spark.createDataFrame(archives, "uri string, size long").select("uri", F.explode(F.expr(f"sequence(0L, greatest(size - 1, 0L), {range_bytes}L)")).alias("start"))
    count = sum(-(-size // range_bytes) for _, size in archives) or 1
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, size = [], 0
                for raw in members(_Source(uri), start, start + range_bytes):
                    held.append(parse(raw))
                    size += len(raw)
                    if size > 4 * _BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    return ranges.repartition(max(1, count), "uri", "start").mapInArrow(run, RECORD)


def archive_pages(pages: DataFrame, uri: str | None = None) -> DataFrame:
    """Writes every page as a WARC record and reads the archives back: one row per record, columns as in ``RECORD``.

    Null html is an empty payload; payloads below 1,000 bytes are always responses; a null url is an empty one. Of repeated rows with
    the same id, url and payload each is written, all as what their group makes of them. An empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    uri = uri or f"{shared_root(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(spark, write_archives(plan_revisits(pages), uri))
