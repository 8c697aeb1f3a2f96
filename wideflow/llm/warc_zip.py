"""WARC records in ZIP packages: a writer, and a reader that never extracts.

A package (one per task and size limit) holds stored members: ``archive/data.warc``
with the records and ``indexes/index.cdxj`` with one JSON line per record (offset and
length within the archive member). The reader parses the end record, the ZIP64 locator
and directory where there are any, and the central directory; takes the data offset of a
stored member from its local header; and reads records by range.

Records of equal payload (SHA-256) of at least ``min_revisit`` bytes: those with the
smallest id are ``response``, others ``revisit`` that name it and carry the headers only.

Defined cases: a null payload is empty; a null url leaves out the target header; rows
with a null id are written, order after all ids and read back with a null id; rows that
repeat the smallest id of their payload are all ``response``; other columns are not read; an empty table makes no package and reads back
as no rows. Files of failed task attempts stay unnamed in the manifest and are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideflow.session import fresh_path

from .common import find_package, small_enough, staged

ARCHIVE, INDEX = "archive/data.warc", "indexes/index.cdxj"
#: Payload bytes after which a package is closed and the next one begun.
PACKAGE_BYTES = 64_000_000
#: Groups of equal payloads of up to so many digests are broadcast; beyond it the rows are shuffled.
BROADCAST_GROUPS = 200_000
_DATE = "2000-01-01T00:00:00Z"


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write_package(folder: str, name: str, records: list[tuple]) -> tuple[str, int, int]:
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    index, at = [], 0
    with where.open_output_stream(f"{path}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True) as member:
            for page_id, url, payload, digest, refers_to in records:
                r = _record(page_id, url, payload, digest, refers_to)
                member.write(r)
                index.append(json.dumps({"id": page_id, "url": url, "offset": at, "length": len(r), "digest": f"sha256:{digest}"}))
                at += len(r)
        with z.open(zipfile.ZipInfo(INDEX), "w") as member:
            member.write("".join(x + "\n" for x in index).encode())
    return f"{folder}/{name}", at, len(records)


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 100) -> DataFrame:
    """Writes a record per row to packages in the shared folder; the manifest ``(path, bytes, records)``."""
    find_package(pages)
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    if "://" not in folder:
        folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") else f"file://{folder}"
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    groups = staged(p.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
                    .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
                    .select("digest", "first"), "payload-groups")
    side = F.broadcast(groups) if small_enough(groups, BROADCAST_GROUPS) else groups
    rows = (p.join(side, "digest", "left")
            .select("id", "url", "payload", "digest",
                    F.when((F.octet_length("payload") >= min_revisit) & F.col("first").isNotNull()
                           & ~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        held, size, made = [], 0, 0

        def close():
            nonlocal held, size, made
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.wacz"
            path, n_bytes, n = _write_package(folder, name, held)
            held, size, made = [], 0, made + 1
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [n_bytes], "records": [n]})

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(r)
                size += len(r[2])
                if size >= PACKAGE_BYTES:
                    yield close()
        if held:
            yield close()

    return staged(rows.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


class ZipReader:
    """The stored members of a ZIP file, by ranged reads through ``read_at(length, offset)``."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail_at = max(0, size - 65_557)  # an end record and the longest comment
        tail = read_at(size - tail_at, tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        entries, length, offset = struct.unpack_from("<HII", tail, end + 10)
        if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            locator = read_at(20, tail_at + end - 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            record = read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
        self.members = self._directory(read_at(length, offset), entries)

    @staticmethod
    def _directory(d: bytes, entries: int) -> dict[str, tuple[int, int, int]]:
        """name -> (method, stored size, local header offset)."""
        members, at = {}, 0
        for _ in range(entries):
            if d[at:at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", d, at + 8)
            stored, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", d, at + 20)
            offset = struct.unpack_from("<I", d, at + 42)[0]
            name = d[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, x = d[at + 46 + n_name:at + 46 + n_name + n_extra], 0
            while x + 4 <= len(extra):
                tag, n = struct.unpack_from("<HH", extra, x)
                if tag == 1:  # 64-bit values, present only for fields that are all ones, in this order
                    y = x + 4
                    if full == 0xFFFFFFFF:
                        y += 8
                    if stored == 0xFFFFFFFF:
                        stored, y = struct.unpack_from("<Q", extra, y)[0], y + 8
                    if offset == 0xFFFFFFFF:
                        offset = struct.unpack_from("<Q", extra, y)[0]
                x += 4 + n
            members[name] = method, stored, offset
            at += 46 + n_name + n_extra + n_comment
        return members

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's data in the file."""
        method, stored, offset = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        local = self.read_at(30, offset)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return offset + 30 + n_name + n_extra, stored


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record; header names in lower case."""
    def headers(block: bytes) -> dict[str, str]:
        lines = block.decode("utf-8").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    warc = headers(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, headers(http), payload


def _page_id(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    for b in batches:
        for path in b.column(0).to_pylist():
            where, inner = fs.FileSystem.from_uri(path)
            with where.open_input_file(inner) as f:
                z = ZipReader(lambda n, at, f=f: f.read_at(n, at), f.size())
                at, n = z.place(INDEX)
                entries = [json.loads(x) for x in f.read_at(n, at).decode().split("\n") if x]
                base, _ = z.place(ARCHIVE)
                rows, held = [], 0
                for e in entries:
                    warc, http, payload = parse_record(f.read_at(e["length"], base + e["offset"]))
                    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
                    rows.append((_page_id(warc["warc-record-id"]), e["url"], kind, payload if kind == "response" else None,
                                 int(http["content-length"]), digest, _page_id(warc.get("warc-refers-to"))))
                    held += len(payload)
                    if held >= 8_000_000 or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_packages(manifest: DataFrame, id_col: str = "page_id") -> DataFrame:
    """A row per record of the packages: ``(id_col, url, record_type, payload, payload_bytes, payload_digest, refers_to)``.

    ``payload`` is null for revisits; ``payload_bytes`` and the digest are always of the
    full payload (a response's is checked against its digest).
    """
    find_package(manifest)
    return (manifest.select("path").repartition(max(1, manifest.count()), "path")
            .mapInArrow(_read, "id long, url string, record_type string, payload binary, payload_bytes long, "
                               "payload_digest string, refers_to long").withColumnRenamed("id", id_col))
