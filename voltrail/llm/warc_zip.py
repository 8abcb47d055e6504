"""WARC records in ZIP packages: writing, and reading by byte ranges without extraction.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, records that are one
gzip member each, and ``indexes/index.cdxj``, a line a record with its offset and length.  The
reader finds the central directory from the end of the file (the ZIP64 one where there is one),
locates the stored members, reads the index by range, and reads records by the ranges that the
index names; tasks share the ranges of a large package.

Packages are written by tasks into the shared folder, under names of their own, and listed in a
manifest table that Spark commits: what a lost or repeated task has written isn't in the manifest
and is never read.  Paths may be of any file system that Arrow opens by URI.

Of rows with equal payloads the one with the largest page_id is a response and the others revisit
it.  Null html is an empty payload.  Rows alike in page_id and payload are all responses; a null
page_id is smaller than any other, and a revisit of one refers to null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.llm.store import new_path, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE = 256 << 20  # bytes of records after which a task starts another package
RANGE = 8 << 20  # bytes that a task reads at a time
WIDE, SHORT = 0xFFFFFFFF, 0xFFFF


# --- ZIP -----------------------------------------------------------------------------------------

class PackageWriter:
    """A ZIP64 file of stored members, written front to back."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        # Sizes and checksum follow the data (flag 8); names are UTF-8 (flag 0x800).
        self.put(struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x808, 0, 0, 0x21, 0, WIDE, WIDE, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self.members[-1][2] += len(data)
        self.members[-1][3] = zlib.crc32(data, self.members[-1][3])
        self.put(data)

    def end(self) -> None:
        _, _, size, crc = self.members[-1]
        self.put(struct.pack("<4sI2Q", b"PK\7\10", crc, size, size))

    def close(self) -> None:
        start = self.at
        for raw, at, size, crc in self.members:
            self.put(struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x808, 0, 0, 0x21, crc, WIDE, WIDE, len(raw), 28, 0, 0, 0, 0, WIDE) + raw + struct.pack("<2H3Q", 1, 24, size, size, at))
        size, end, n = self.at - start, self.at, len(self.members)
        self.put(struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, start))
        self.put(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
        self.put(struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, SHORT, SHORT, WIDE, WIDE, 0))


def read_at(f, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def directory(f, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset, size) of the data of each stored member, from the file's end and its directory alone."""
    tail_at = max(0, size - 65557)  # the last record and the longest comment
    tail = read_at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6", 0, len(tail) - 18)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\5\6", 0, end)  # these bytes stand in the comment
    if end < 0:
        raise ValueError("no ZIP directory")
    n, length, start = struct.unpack_from("<10xH2I", tail, end)
    locator = read_at(f, tail_at + end - 20, 20) if tail_at + end >= 20 else b""
    if locator[:4] == b"PK\6\7":
        wide = read_at(f, struct.unpack_from("<8xQ", locator)[0], 56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 directory where its locator points")
        n, length, start = struct.unpack_from("<32x3Q", wide)
    listing = read_at(f, start, length)
    out, at = {}, 0
    for _ in range(n):
        if listing[at:at + 4] != b"PK\1\2":
            raise ValueError("broken ZIP directory")
        method, packed, full, n_name, n_extra, n_comment, offset = struct.unpack_from("<10xH8x2I3H8xI", listing, at)
        name = listing[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra, e = listing[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, m = struct.unpack_from("<2H", extra, e)
            if kind == 1:  # the wide values, of those fields that are full
                wide, values = extra[e + 4:e + 4 + m], []
                for v in (full, packed, offset):
                    if v == WIDE:
                        v, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
                    values.append(v)
                full, packed, offset = values
            e += 4 + m
        if method == 0:
            head = read_at(f, offset, 30)
            out[name] = (offset + 30 + sum(struct.unpack_from("<26x2H", head)), packed)
        at += 46 + n_name + n_extra + n_comment
    return out


# --- WARC ----------------------------------------------------------------------------------------

def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parsed(raw: bytes) -> dict:
    """A record's page, payload (None of a revisit), type and digest; the digest of a payload that is there is computed from it."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = fields(head)
    body = rest[:int(h["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    if h["warc-type"] == "revisit":
        return {"page_id": page_of(h["warc-record-id"]), "payload": None, "payload_bytes": int(fields(http)["content-length"]), "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"), "record_type": "revisit", "refers_to": page_of(h["warc-refers-to"])}
    digest = sha1_base32(payload)
    if "sha1:" + digest != h["warc-payload-digest"]:
        raise ValueError(f"payload of {h['warc-record-id']} isn't what was written")
    return {"page_id": page_of(h["warc-record-id"]), "payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "record_type": "response", "refers_to": None}


# --- Spark ---------------------------------------------------------------------------------------

def opened(uri: str):
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, revisit and refers_to of each page."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    last = rows.select("page_id", "digest").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(last.withColumn("several", F.lit(True)), "digest", "left")
    revisit = F.coalesce(F.col("several"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("last")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every page as a record into packages in ``folder``; the manifest: path, records, bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        package = None

        def finish() -> pa.RecordBatch:
            package.end()
            package.begin(INDEX)
            for line in lines:
                package.write(line)
            package.end()
            package.close()
            out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": len(lines), "bytes": package.at}])

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, revisit, refers_to = (c[i].as_py() for c in columns)
                if package is None:
                    name, lines, at = f"{uuid.uuid4().hex}.zip", [], 0
                    out = system.open_output_stream(f"{base}/{name}")
                    package = PackageWriter(out)
                    package.begin(ARCHIVE)
                data = gzip.compress(record(page_id, url, payload, refers_to, revisit), 1, mtime=0)
                package.write(data)
                lines.append(f"{page_id} 20000101000000 {json.dumps({'offset': at, 'length': len(data), 'mime': 'warc/revisit' if revisit else 'text/html'})}\n".encode())
                at += len(data)
                if at >= PACKAGE:
                    yield finish()
                    package = None
        if package is not None:
            yield finish()

    listed = with_revisits(pages).mapInArrow(write, "path string, records bigint, bytes bigint")
    return written(listed, "packages")


def read_packages(manifest: DataFrame) -> DataFrame:
    """Every record of the listed packages: page_id, payload, payload_bytes, payload_digest, record_type, refers_to."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = opened(path)
                with system.open_input_file(base) as f:
                    members = directory(f, f.size())
                    (data, _), (index, size) = members[ARCHIVE], members[INDEX]
                    rest, at, lengths = b"", None, []
                    for a in range(0, size, RANGE):
                        *lines, rest = (rest + read_at(f, index + a, min(RANGE, size - a))).split(b"\n")
                        for line in lines:
                            entry = json.loads(line.split(b" ", 2)[2])
                            if lengths and entry["offset"] + entry["length"] - at > RANGE:
                                yield pa.RecordBatch.from_pylist([{"path": path, "at": data + at, "lengths": lengths}], schema=parts)
                                lengths = []
                            at = entry["offset"] if not lengths else at
                            lengths.append(entry["length"])
                    if lengths:
                        yield pa.RecordBatch.from_pylist([{"path": path, "at": data + at, "lengths": lengths}], schema=parts)

    parts = pa.schema([("path", pa.string()), ("at", pa.int64()), ("lengths", pa.list_(pa.int64()))])
    rows = pa.schema([("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                system, base = opened(part["path"])
                with system.open_input_file(base) as f:
                    raw, at, out = read_at(f, part["at"], sum(part["lengths"])), 0, []
                for n in part["lengths"]:
                    out.append(parsed(zlib.decompress(raw[at:at + n], wbits=31)))
                    at += n
                yield pa.RecordBatch.from_pylist(out, schema=rows)

    n = max(1, -(-(manifest.agg(F.sum("bytes")).first()[0] or 0) // (2 * RANGE)))
    paths = manifest.select("path").repartition(max(1, min(n, manifest.count())))
    found = paths.mapInArrow(ranges, "path string, at bigint, lengths array<bigint>")
    return found.repartition(n).mapInArrow(records, "page_id bigint, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages and reads all records back."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return read_packages(write_packages(pages, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
