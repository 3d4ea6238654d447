"""WARC archives: one gzip member per record, written and read record by record.

Writing goes through Spark's own text sink, so that archives land atomically on
any file system and survive lost executors. A gzip member ends with the high
byte of its length; the sink's line separator is that byte, so the rows of the
sink, one per member without its last byte, make an exact multi-member file.
Records of 16 MiB and more end with another byte and get files of their own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import put
from tidemark.session import scratch_path

SLICE = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD_SCHEMA = ("page string, record_type string, target string, refers_to string, payload binary, payload_digest string, "
                 "declared_bytes bigint, block_ok boolean, payload_ok boolean, archive string, offset bigint")


def _digest(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _uri(page: str | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _header_value(text: str) -> str:
    """A header value on one line: bytes outside the printable ASCII are percent-encoded."""
    return "".join(chr(b) if 0x21 <= b < 0x7F else f"%{b:02X}" for b in text.encode())


def record(page: str | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: str | None, last: int = 0) -> bytes:
    """One gzip member; ``last`` is the byte that it has to end with (see ``write_warc``)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_value(url) if url else 'urn:page:no-address'}", "Content-Type: application/http;msgtype=response",
        f"WARC-Block-Digest: {_digest(hashlib.sha1(block).hexdigest())}", f"WARC-Payload-Digest: {_digest(sha1_hex)}"]
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    fields.append(f"Content-Length: {len(block)}")

    def whole(extra: list[str]) -> bytes:
        return "\r\n".join(fields + extra).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    raw = whole([])
    if len(raw) >> 24 < last:
        raw = whole(["Filler: " + "." * ((last << 24) - len(raw))])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def decided(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Pages with their payload and, for revisits, the page that is the response.

    Only digests and lengths are grouped, map-side first. The digests that occur
    more than once are written as a table, so the join with the payloads knows its
    size: few are broadcast below Spark's size limit, many are joined by a shuffle
    that adaptive execution splits where a payload is hot.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")).withColumns({
                            "sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    leaders = rows.where(F.col("bytes") >= least).groupBy("sha1", "bytes").agg(
        F.max("id").alias("first_of"), F.count(F.lit(1)).alias("times")).where("times > 1 and first_of is not null").drop("times")
    joined = rows.join(put(leaders, "repeated-payloads"), ["sha1", "bytes"], "left")
    # a row without an id cannot be named, so nothing refers to it, but it may refer
    other = F.col("first_of").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_of"))
    return joined.select(F.col("id").cast("string").alias("page"), "url", "payload", "sha1", "bytes",
                         F.when(other, F.col("first_of").cast("string")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 1000,
               records_per_file: int = 5000) -> None:
    """Write a record per row below ``path``, in archives of at most ``records_per_file`` records.

    Rows whose payloads, of ``least`` bytes or more, are equal are written once:
    that with the largest id is the response, the others are revisits of it.
    Equal rows with the largest id are all responses. Null and empty payloads are
    empty responses. A null url gets a placeholder; a null id is written as such.
    """
    rows = decided(pages, page_id, url, html, least)
    # the class of the last byte: the length of the record, rounded up by more than its headers can take
    room = F.octet_length(F.coalesce("url", F.lit(""))) * 3 + 4096
    stored = F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0)
    rows = rows.withColumn("last", F.shiftright(stored + room, 24).cast("int"))
    lengths = pages.select(F.shiftright(F.octet_length(F.coalesce(F.col(html), F.lit("")))
                                        + F.octet_length(F.coalesce(F.col(url).cast("string"), F.lit(""))) * 3 + 4096, 24).cast("int").alias("last"))
    largest = lengths.agg(F.max("last")).first()[0] or 0

    def run(batches):
        for batch in batches:
            for small in _sliced(batch):
                made = [record(r["page"], r["url"], r["payload"], r["sha1"], r["refers_to"], r["last"])[:-1] for r in small.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    # at most 128 classes: a length is below 2 GiB; nearly always there is one
    for last in range(largest + 1):
        part = rows.where(F.col("last") == last).drop("bytes").mapInArrow(run, "member binary")
        part.select(F.col("member").cast("string").alias("value")).write.mode("append").option("lineSep", chr(last)).option(
            "encoding", "ISO-8859-1").option("compression", "none").option("maxRecordsPerFile", records_per_file).text(path)


def _sliced(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class Damaged(ValueError):
    pass


@dataclass
class Framed:
    offset: int
    fields: dict[str, str]
    block: bytes


def members(content: memoryview) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of each gzip member, decompressed slice by slice: one member is held at a time."""
    at, end = 0, len(content)
    while at < end:
        start, stream, parts = at, zlib.decompressobj(31), []
        while not stream.eof:
            if at >= end:
                raise Damaged(f"member at {start} is cut off")
            piece = content[at:at + SLICE]
            try:
                parts.append(stream.decompress(piece))
            except zlib.error as e:
                raise Damaged(f"member at {start}: {e}") from None
            at += len(piece) - len(stream.unused_data)
        yield start, b"".join(parts)


def framed(content: memoryview) -> Iterator[Framed]:
    """Records by their content length; a length that does not fit its member is damage."""
    for offset, raw in members(content):
        head, mark, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not mark or not lines[0].startswith("WARC/"):
            raise Damaged(f"no record at {offset}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields.get("content-length", "-1"))
        if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
            raise Damaged(f"record at {offset}: content length {length} does not fit")
        yield Framed(offset, fields, rest[:length])


def _named(uri: str | None) -> str | None:
    name = uri[len("<urn:page:"):-1] if uri and uri.startswith("<urn:page:") else None
    return None if name == "none" else name


def _row(found: Framed, archive: str) -> dict:
    f = found.fields
    http, _, payload = found.block.partition(b"\r\n\r\n")
    declared = next((int(line.split(b":", 1)[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")), None)
    said = f.get("warc-payload-digest", "")
    hexed = base64.b32decode(said[5:]).hex() if said.startswith("sha1:") else None
    revisit = f.get("warc-type") == "revisit"
    return {
        "page": _named(f.get("warc-record-id")), "record_type": f.get("warc-type"), "target": f.get("warc-target-uri"),
        "refers_to": _named(f.get("warc-refers-to")), "payload": None if revisit else payload, "payload_digest": hexed, "declared_bytes": declared,
        "block_ok": f.get("warc-block-digest") == _digest(hashlib.sha1(found.block).hexdigest()),
        "payload_ok": None if revisit else hashlib.sha1(payload).hexdigest() == hexed and declared == len(payload),
        "archive": archive, "offset": found.offset}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``.

    Columns: ``page`` (the record's page id as text), ``record_type``, ``target``,
    ``refers_to``, ``payload`` (null for revisits), ``payload_digest`` (hex
    SHA-1), ``declared_bytes`` (length of the full payload), ``block_ok`` and
    ``payload_ok`` (the digests hold), ``archive`` and ``offset``. A cut or
    damaged archive raises. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")

    def run(batches):
        schema = pa.schema([("page", pa.string()), ("record_type", pa.string()), ("target", pa.string()), ("refers_to", pa.string()),
                            ("payload", pa.binary()), ("payload_digest", pa.string()), ("declared_bytes", pa.int64()),
                            ("block_ok", pa.bool_()), ("payload_ok", pa.bool_()), ("archive", pa.string()), ("offset", pa.int64())])
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for found in framed(memoryview(content.as_buffer())):
                    held.append(_row(found, path.as_py()))
                    size += len(found.block)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(run, RECORD_SCHEMA)


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to fresh archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, **options)
    return read_warc(spark, path)
