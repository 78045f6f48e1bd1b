"""WARC archives of web pages, written and read in chunks (operator 9).

*Chunked record table*: a payload is streamed as rows of (record, chunk number,
bytes), each with the digest of all bytes so far; a chunk is a WARC record of
its own (a response and its continuations, the format's segments), so no row
and no buffer is larger than a chunk, however large a page is. Spark's text
writer puts the rows out with the line end that the format has anyway, so the
files are gzipped WARC files on any file system Spark reaches, committed by
Spark's own protocol. The reader takes the lines as a stream, follows
Content-Length, and digests the payload as it passes.

Equal payloads are stored once: the record with the smallest page_id is a
response, the others revisit it. Only digests are shuffled by digest, so
a payload that a third of all pages have is no hot group.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_rows

CHUNK = 1 << 18
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

CHUNKS = "record_id string, chunk int, value binary, bytes long, digest string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{sha1}>"


def _pieces(data: memoryview, chunk: int) -> Iterator[memoryview]:
    """Cuts of at most ``chunk`` bytes that split no character."""
    at = 0
    while at < len(data):
        end = min(len(data), at + chunk)
        while at < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its last line end, which the writer adds."""
    head = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"WARC-Block-Digest: sha1:{b32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def chunk_table(records: DataFrame, chunk: int = CHUNK, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The rows of (record_id, chunk, value, bytes, digest) that make up the
    archive: ``value`` is a WARC record, ``bytes`` and ``digest`` (SHA-1) are
    those of the payload up to and with this chunk."""
    def run(cols) -> Iterator[dict]:
        out, held = {c: [] for c in ("record_id", "chunk", "value", "bytes", "digest")}, 0
        for page, url, payload, refers, sha1 in zip(cols["page_id"].to_pylist(), cols["url"].to_pylist(), cols["payload"], cols["refers_to"].to_pylist(), cols["sha1"].to_pylist()):
            data = memoryview(payload.as_buffer())
            name = record_id(page, sha1)
            whole = f"sha1:{b32(bytes.fromhex(sha1))}"
            fields = [("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Date", date), ("WARC-Payload-Digest", whole), ("X-Payload-Length", len(data))]
            if refers is not None:
                rows = [([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, sha1)),
                          ("Content-Type", "application/http; msgtype=response")], HTTP_HEAD, len(data), whole[5:])]
            else:
                rows = _segments(name, fields, data, chunk)
            for i, (head, block, n, digest) in enumerate(rows):
                for c, v in zip(out, (name, i, _record(head, block), n, digest)):
                    out[c].append(v)
                held += len(block)
                if held > 4 << 20:
                    yield out
                    out, held = {c: [] for c in out}, 0
        yield out

    return map_rows(records.select("page_id", "url", F.col("payload").cast("binary").alias("payload"), "refers_to", "sha1"), run, CHUNKS)


def _segments(name: str, fields: list, data: memoryview, chunk: int) -> Iterator[tuple]:
    sofar, n = hashlib.sha1(), 0
    for i, piece in enumerate(_pieces(data, chunk) if len(data) else [data]):
        sofar.update(piece)
        n += len(piece)
        many = len(data) > len(piece)
        kind = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{i}>"), ("WARC-Segment-Origin-ID", name)] if i else [("WARC-Type", "response"), ("WARC-Record-ID", name)]
        more = [("WARC-Segment-Number", i + 1 if many else None), ("WARC-Segment-Total-Length", len(HTTP_HEAD) + n if i and n == len(data) else None),
                ("X-Digest-So-Far", f"sha1:{b32(sofar.digest())}"), ("Content-Type", None if i else "application/http; msgtype=response")]
        yield [*kind, *fields, *more], bytes(piece) if i else HTTP_HEAD + bytes(piece), n, b32(sofar.digest())


def archive_records(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to) of every page. Of equal
    payloads of at least ``least`` bytes, refers_to is the smallest page_id
    on all larger ones."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"))
    light = scratch.save(rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).select("page_id", "sha1"), "digests")
    first = scratch.save(light.groupBy("sha1").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("sha1", "first"), "first")
    again = light.join(first, "sha1").where("page_id > first").select("page_id", "sha1", F.col("first").alias("refers_to")).distinct()
    return rows.join(scratch.save(again, "again"), ["page_id", "sha1"], "left")


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, least: int = 0, chunk: int = CHUNK) -> None:
    """Gzipped WARC files of ``pages`` in ``folder``. The chunks of a record
    follow each other in one file."""
    table = chunk_table(archive_records(pages, scratch, least), chunk)
    table.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(folder)


class _Stream:
    """A parser of records that is fed one line at a time and holds the
    header only."""

    def __init__(self):
        self.head: list[bytes] | None = []
        self.left = self.skip = 0
        self.fields: dict[str, str] = {}
        self.page: dict | None = None
        self.sha1 = hashlib.sha1()

    def feed(self, line: bytes) -> dict | None:
        """The record that this line shows to be over, if any."""
        if self.head is None:
            part, rest = line[:self.left], line[self.left:]
            if self.skip:
                over = min(self.skip, len(part))
                self.skip -= over
                part = part[over:]
                self.left -= over
            self.sha1.update(part)
            self.page["payload_bytes"] += len(part)
            self.left -= len(part)
            if not self.left and rest:
                if rest != b"\r\n":
                    raise ValueError("a record goes on beyond its length")
                self.head = []
            return None
        if line != b"\r\n":
            self.head.append(line.rstrip(b"\r\n"))
            return None
        if not self.head:
            return None  # the empty line after a record
        if self.head[0] != VERSION.encode():
            raise ValueError("not a WARC record")
        self.fields = dict(h.decode().split(": ", 1) for h in self.head[1:])
        kind, done = self.fields["WARC-Type"], None
        if kind == "continuation":
            if self.page is None or self.fields["WARC-Segment-Origin-ID"] != self.page["id"]:
                raise ValueError("a continuation without its record")
            self.skip = 0
        else:
            done = self.end()
            self.page = dict(id=self.fields["WARC-Record-ID"], kind=kind, refers=self.fields.get("WARC-Refers-To"), digest=self.fields["WARC-Payload-Digest"][5:],
                             payload_bytes=0, length=int(self.fields["X-Payload-Length"]))
            self.skip, self.sha1 = len(HTTP_HEAD), hashlib.sha1()
        self.head, self.left = None, int(self.fields["Content-Length"])
        return done

    def end(self) -> dict | None:
        """The record read last, its payload checked against its header."""
        r, self.page = self.page, None
        if r is None:
            return None
        if self.left:
            raise ValueError("an archive ends within a record")
        if r["kind"] == "response" and (r["payload_bytes"], b32(self.sha1.digest())) != (r["length"], r["digest"]):
            raise ValueError(f"payload of {r['id']} doesn't match its digest")
        number = lambda urn: int(n) if urn and (n := urn.split(":")[2]) else None
        return dict(page_id=number(r["id"]), payload_bytes=r["length"], payload_digest=r["digest"], record_type=r["kind"], refers_to=number(r["refers"]))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``: page_id,
    payload_bytes, payload_digest, record_type, refers_to. Payloads are
    digested as they are read and must match the headers. A gzipped file
    is read by one task from its start, so its lines come in order."""
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("line"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        stream, out = _Stream(), []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in zip(names, kinds)], names=names)

        for b in batches:
            for line in b.column(0):
                if done := stream.feed(line.as_py() + b"\n"):
                    out.append(done)
            yield batch()
            out = []
        if done := stream.end():
            out.append(done)
        yield batch()

    return lines.mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to WARC archives in the scratch
    folder and reads them back, one row per page.

    A null html is an empty payload, a null url gives no target. Rows with a
    null page_id are responses that none refers to. Rows that repeat a page_id
    and a payload have the same smallest page_id and are alike: all responses,
    or all revisits.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    write_archives(pages, scratch.path("archives"), scratch, least, chunk)
    return read_archives(pages.sparkSession, scratch.path("archives"))


SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
f as (select h, min(page_id) as low from p group by h),
x as (select page_id, strlen(h)::bigint as payload_bytes, sha1(h) as hex, case when page_id > low then low end as refers_to from p join f using (h))
select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::int >> (5 * (3 - i % 4))::int) & 31), 1)), '') as payload_digest,
  case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to
from x
"""
