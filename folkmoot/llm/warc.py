"""WARC archives: a deduplicating writer and a splittable reader.

Each record is a gzip member of its own. The reader deals byte ranges of the
archives to tasks. A task looks for gzip magic from the start of its range on,
takes as its first member the first candidate that decodes to a WARC header,
and from there reads member after member; it owns the records that start inside
its range, wherever they end. Archives are opened by Arrow's file systems
(local, HDFS, S3, GCS), so neither side holds more than one record.

A task writes under a name of its own, and only the names that a successful task
returned are in the manifest; a retried task leaves a file that nobody reads.

Edge cases: null payloads are empty; payloads below ``least`` bytes are never
revisits; null ids are written and read as null and refer to nothing; rows that
repeat the least id of a payload are all responses; control characters in a URL
are percent-encoded in the header; an empty table gives no archive; other columns
are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, written

LEAST, SPLIT, CHUNK, LEVEL, MOST_TASKS = 100, 16 << 20, 1 << 18, 1, 20_000
#: The records' time: the tables have none.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, str(i))}>"
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Page-Id", "" if page_id is None else page_id),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)), ("Refers-To-Page-Id", refers_to)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """Write the archives under ``folder``; returns the manifest ``(file, size, records)``."""
    spark = pages.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    kind = pages.schema[payload_col].dataType.simpleString()
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary") if kind == "string" else F.coalesce(F.col(payload_col), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    again = (
        rows.where(F.octet_length("payload") >= least)
        .select("id", "digest")
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select(F.col("digest").alias("d"), "first")
    )
    dealt = rows.join(again, F.col("digest") == F.col("d"), "left").select("id", "url", "payload", "digest", F.when(F.col("first") != F.col("id"), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, count, out = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    system, path = fs.FileSystem.from_uri(name)
                    out = system.open_output_stream(path, compression=None)
                member = record(*row)
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([count])], names=["file", "size", "records"])

    return written(dealt.mapInArrow(run, "file string, size long, records long"), "manifest")


class _Members:
    """The gzip members of an open archive, from a byte on."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(min(n, self.size - at))

    def valid(self, at: int) -> bool:
        """Whether a member that starts here decodes to a WARC header."""
        try:
            head = zlib.decompressobj(31).decompress(self._at(at, CHUNK), 1 << 14)
        except zlib.error:
            return False
        return head.startswith(b"WARC/1.") and b"\r\nWARC-Type: " in head

    def first(self, lo: int, hi: int) -> int | None:
        """The start of the first valid member in ``[lo, hi)``."""
        while lo < hi:
            data = self._at(lo, min(CHUNK, hi - lo) + len(MAGIC) - 1)
            k = data.find(MAGIC)
            while k >= 0:
                if self.valid(lo + k):
                    return lo + k
                k = data.find(MAGIC, k + 1)
            lo += CHUNK
        return None

    def read(self, lo: int, hi: int) -> Iterator[bytes]:
        """The decoded members that start in ``[lo, hi)``."""
        start = self.first(lo, hi)
        if start is None:
            return
        at, data = start, b""
        while start < hi:
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:
                if not data:
                    data, at = self._at(at, CHUNK), min(self.size, at + CHUNK)
                    if not data:
                        raise EOFError(f"the member at {start} is cut off")
                parts.append(unpack.decompress(data))
                data = unpack.unused_data
            yield b"".join(parts)
            start = at - len(data)
            if start >= self.size:
                return


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}
    return fields, rest[: int(fields["content-length"])]


def _row(member: bytes, with_payload: bool) -> tuple:
    fields, block = parse(member)
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    number = lambda x: int(x) if x else None
    size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http + b"\r\n")[1])
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} does not have its digest")
    return number(fields["page-id"]), fields["warc-target-uri"], size, digest, fields["warc-type"], number(fields.get("refers-to-page-id")), payload if with_payload else None


SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read(manifest: DataFrame, split: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """The records of the archives in ``manifest`` (``file``, ``size``), by byte ranges of ``split``.

    Revisits have no payload; the digest of a response is computed again and must agree.
    """
    ranges = manifest.where("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long"))).alias("lo"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, size, lo in zip(*(c.to_pylist() for c in b.columns)):
                system, path = fs.FileSystem.from_uri(name)
                rows, held = [], 0
                with system.open_input_file(path) as source:
                    for member in _Members(source, size).read(lo, min(lo + split, size)):
                        rows.append(_row(member, with_payload))
                        held += len(member) if with_payload else 500
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

    # Ranges are tiny rows with much work behind each: adaptive plans must not put them together.
    tasks = manifest.agg(F.sum(F.ceil(F.col("size") / split))).first()[0] or 1
    return ranges.repartition(min(int(tasks), MOST_TASKS)).mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back."""
    return read(write(pages, new_path(pages.sparkSession, "warc")), split, with_payload=False).drop("payload")
