"""WARC records in ZIP packages: writing them, and range-reading them without extraction.

A package holds stored (uncompressed) members: ``archive/data.warc.gz`` with a
gzip member for each record, and ``indexes/index.cdxj`` with the place of each
record.  ``members`` reads a package's end and central directory, ZIP64 forms
included, so it finds members of any size with a few short range reads;
``locate`` turns the indexes into ranges of whole records, and ``read_records``
reads just these ranges, in parallel within and across packages.

Files are opened through the file system that their URI names, in the tasks.
A task writes under a name of its own and hands the name on; only packages
named in the written manifest are read, so a task that ran twice, or was lost,
leaves no double records.

White space and control characters of a URL are percent-encoded in its header;
such a URL also stands whole, as a JSON string, in a header of its own, so every
URL reads back as it was and none can end a line.  Ids are percent-encoded too.

Defined results: a null payload is empty; a null id, url or payload is read
back as null, null and empty, an empty id as null; of records with equal payloads of at least
``least_bytes`` bytes the one of the smallest id is the response (each, if
several rows share that id) and the others revisit it; records with null ids
are responses if no other has their payload.  An empty table gives no package
and no records.  Other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm.shared import shared_path, short_batches, stored

#: A package is closed after the record that reaches one of these.
PACKAGE_BYTES, PACKAGE_RECORDS = 128 << 20, 50_000
RANGE_BYTES = 4 << 20
STORED_TIME = (1980, 1, 1, 0, 0, 0)
#: Signatures and sizes of the ZIP format's records.
END, END_SIZE = b"PK\x05\x06", 22
END64_PLACE, END64_PLACE_SIZE = b"PK\x06\x07", 20
END64, ENTRY, ENTRY_SIZE, LOCAL_SIZE, EXTRA64 = b"PK\x06\x06", b"PK\x01\x02", 46, 30, 1
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# Writing


def digests(df: DataFrame, key: str, payload: str, least_bytes: int) -> DataFrame:
    """``df`` with the payload's hex SHA-1 and the id that a revisit refers to (null for responses).

    Only ids and digests meet by digest, minima first; the few ids of revisits
    are joined back by id and digest, so payloads that very many rows share are
    never dealt out by their digest.
    """
    rows = df.withColumn("__sha1", F.sha1(F.coalesce(payload, F.lit("")).cast("binary")))
    narrow = rows.where(F.octet_length(F.coalesce(payload, F.lit(""))) >= least_bytes).select(F.col(key).alias("__id"), F.col("__sha1").alias("__same"))
    first = narrow.groupBy(F.col("__same").alias("__of")).agg(F.min("__id").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    revisits = narrow.join(first, F.col("__same") == F.col("__of")).where(~F.col("__id").eqNullSafe(F.col("__first"))).select("__id", "__same", "__first").distinct()
    return rows.join(revisits, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__sha1") == F.col("__same")), "left").drop("__id", "__same")


def record(key: object, url: str | None, payload: bytes, sha1: bytes, refers_to: object) -> bytes:
    """A WARC record: response, or revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(key)}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_uri(url)}")
        if header_uri(url) != url:
            head.append(f"X-Target-URI: {json.dumps(url)}")
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_id(refers_to)}>"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_unfit = re.compile(r"[\s\x00-\x20\x7f-\x9f]").sub


def header_uri(url: str) -> str:
    """``url`` with white space and control characters percent-encoded, so that it is one line and keeps its ends."""
    return _unfit(lambda c: quote(c[0], safe=""), url)


def record_id(key: object) -> str:
    return f"urn:record:{'' if key is None else quote(str(key), safe='')}"


class _Forward(io.RawIOBase):
    """An output stream that knows its place and cannot seek."""

    def __init__(self, out: pa.NativeFile):
        self.out, self.at = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def seekable(self) -> bool:
        return False

    def seek(self, *_):
        raise io.UnsupportedOperation

    def flush(self) -> None:
        pass


class PackageWriter:
    """Writes records to a new package; memory holds one record and the index."""

    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        files, at = opened(self.path)
        files.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(at)
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz", STORED_TIME), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, url: str | None, data: bytes) -> None:
        packed = gzip.compress(data, 3, mtime=0)
        place = {"offset": str(self.size), "length": str(len(packed)), "filename": "data.warc.gz"}
        self.index.append(f"{json.dumps(url)} 19700101000000 {json.dumps(place)}\n")
        self.member.write(packed)
        self.size += len(packed)

    @property
    def full(self) -> bool:
        return self.size >= PACKAGE_BYTES or len(self.index) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo("indexes/index.cdxj", STORED_TIME), "w", force_zip64=True) as member:
            for line in self.index:
                member.write(line.encode())
        self.zip.close()
        self.out.close()
        return self.path, len(self.index)


def write(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> str:
    """Writes a record for each row and returns the path of the manifest (Parquet: path, records)."""
    short_batches(df.sparkSession)
    rows = digests(df.select(key, url, payload), key, payload, least_bytes)
    rows = rows.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"), F.col(payload).cast("string").alias("payload"), F.unhex("__sha1").alias("sha1"), F.col("__first").cast("string").alias("refers_to"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                for row in batch.slice(start, 200).to_pylist():
                    writer = writer or PackageWriter(packages)
                    writer.add(row["url"], record(row["key"], row["url"], (row["payload"] or "").encode(), row["sha1"], row["refers_to"]))
                    if writer.full:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "records": [n for _, n in done]}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    packages, manifest = f"{folder}/packages", f"{folder}/manifest"
    rows.mapInArrow(pack, "path string, records long").write.parquet(manifest)
    return manifest


# Reading


class Package:
    """A ZIP package behind range reads."""

    def __init__(self, path: str):
        files, at = opened(path)
        self.file = files.open_input_file(at)
        self.size = self.file.size()

    def __enter__(self) -> Package:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def range(self, start: int, size: int) -> bytes:
        data = self.file.read_at(size, start)
        if len(data) < size:
            raise ValueError(f"the package ends at {start + len(data)}, before {start + size}")
        return data

    def directory(self) -> tuple[int, int]:
        """Start and size of the central directory."""
        tail_at = max(0, self.size - END_SIZE - FULL16)
        tail = self.range(tail_at, self.size - tail_at)
        at = tail.rfind(END, 0, max(0, len(tail) - END_SIZE + len(END)))
        while at >= 0 and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(END, 0, at)  # those bytes stood in the comment
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP package")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        if FULL16 == count or FULL32 in (size, start):
            place = self.range(tail_at + at - END64_PLACE_SIZE, END64_PLACE_SIZE)
            if place[:4] == END64_PLACE:
                end = self.range(struct.unpack_from("<Q", place, 8)[0], 56)
                if end[:4] != END64:
                    raise ValueError("the ZIP64 end record is not where its locator says")
                size, start = struct.unpack_from("<QQ", end, 40)
        return start, size

    def members(self) -> list[dict]:
        """Name, method, packed and full size, and local header's place of each member."""
        start, size = self.directory()
        data, at, out = self.range(start, size), 0, []
        while at < size:
            if data[at : at + 4] != ENTRY:
                raise ValueError(f"no member's entry at {start + at}")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, full, name_size, extra_size, note_size = struct.unpack_from("<IIHHH", data, at + 20)
            local = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + ENTRY_SIZE : at + ENTRY_SIZE + name_size].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + ENTRY_SIZE + name_size :][:extra_size]
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<HH", extra)
                if kind == EXTRA64:  # holds, in this order, just the values that are full in the entry
                    wide = list(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                    full = wide.pop(0) if full == FULL32 else full
                    packed = wide.pop(0) if packed == FULL32 else packed
                    local = wide.pop(0) if local == FULL32 else local
                extra = extra[4 + length :]
            out.append({"name": name, "method": method, "packed": packed, "full": full, "local": local})
            at += ENTRY_SIZE + name_size + extra_size + note_size
        return out

    def data_start(self, member: dict) -> int:
        """Where a member's bytes start: its local header may have other extra fields than its entry."""
        name_size, extra_size = struct.unpack_from("<HH", self.range(member["local"], LOCAL_SIZE), 26)
        return member["local"] + LOCAL_SIZE + name_size + extra_size

    def read(self, member: dict) -> bytes:
        data = self.range(self.data_start(member), member["packed"])
        if member["method"] == zipfile.ZIP_DEFLATED:
            return zlib.decompress(data, -15)
        if member["method"] != zipfile.ZIP_STORED:
            raise ValueError(f"{member['name']}: method {member['method']} is not supported")
        return data

    def places(self) -> list[tuple[int, int]]:
        """Start in the package and length of each record that the indexes list."""
        members = self.members()
        archives = {m["name"].rpartition("/")[2]: m for m in members if m["name"].startswith("archive/") and m["name"].endswith((".warc", ".warc.gz"))}
        starts = {}
        for name, member in archives.items():
            if member["method"] != zipfile.ZIP_STORED:
                raise ValueError(f"{member['name']} is compressed in its package, so its records have no ranges")
            starts[name] = self.data_start(member)
        out = []
        for member in members:
            if member["name"].startswith("indexes/") and member["name"].endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
                lines = self.read(member)
                lines = gzip.decompress(lines) if member["name"].endswith(".gz") else lines
                for line in lines.decode().splitlines():
                    if "{" in line:
                        place = json.loads(line[line.index("{", line.index(" ") if line[0] != '"' else _key_end(line)) :])
                        out.append((starts[place["filename"]] + int(place["offset"]), int(place["length"])))
        return sorted(out)


def _key_end(line: str) -> int:
    return json.JSONDecoder().raw_decode(line)[1]


def locate(packages: DataFrame, path: str = "path", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, sizes``: runs of adjacent records of about ``range_bytes``, for every package."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own in batch["path"]:
                rows: list[list] = []
                with Package(own) as package:
                    end = -1
                    for start, size in package.places():
                        if start != end or sum(rows[-1][2]) >= range_bytes:
                            rows.append([own, start, []])
                        rows[-1][2].append(size)
                        end = start + size
                yield pd.DataFrame(rows, columns=["path", "start", "sizes"])

    return packages.select(F.col(path).alias("path")).mapInPandas(ranges, "path string, start long, sizes array<long>")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, by lower-case name, and the payload in its block."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if headers.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return headers, block


RECORD = "record_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
ARROW_RECORD = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in RECORD.split(", "))])


def read_records(ranges: DataFrame) -> DataFrame:
    """The records of ``locate``'s ranges; sizes and digests of responses are taken from their bytes."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with Package(row["path"]) as package:
                    data = package.range(row["start"], sum(row["sizes"]))
                out, at = [], 0
                for size in row["sizes"]:
                    headers, payload = parse(data[at : at + size])
                    at += size
                    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = int(headers.get("x-payload-length", 0))
                    if kind == "response":
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest and own != digest:
                            raise ValueError(f"{headers['warc-record-id']}: the payload has another digest than its header")
                        digest, length = own, len(payload)
                    out.append({"record_id": headers["warc-record-id"].strip("<>"), "url": json.loads(headers["x-target-uri"]) if "x-target-uri" in headers else headers.get("warc-target-uri"), "record_type": kind, "refers_to": headers.get("warc-refers-to", "").strip("<>") or None, "payload_bytes": length, "payload_digest": digest, "payload": payload})
                yield pa.RecordBatch.from_pylist(out, ARROW_RECORD)

    return ranges.mapInArrow(records, RECORD)


def read(spark: SparkSession, manifest: str) -> DataFrame:
    """All records of the packages that a manifest names."""
    packages = spark.read.parquet(manifest)
    parts = max(1, spark.sparkContext.defaultParallelism)
    ranges = locate(packages.repartition(parts))
    return read_records(ranges.repartition(parts * 4))


def key_of(column: str) -> Column:
    """The key in a record id that ``write`` made; null if the row had none."""
    return F.url_decode(F.nullif(F.regexp_replace(column, "^urn:record:", ""), F.lit("")))


def resolved(records: DataFrame) -> DataFrame:
    """``records`` without payloads, the size of a revisit taken from the record it refers to.

    A revisit whose record isn't there, or has another digest, is an error.
    """
    rows = stored(records.drop("payload"), "warc-records")
    held = rows.where("record_type = 'response'").groupBy(F.col("record_id").alias("__of"), F.col("payload_digest").alias("__digest")).agg(F.max("payload_bytes").alias("__bytes"))
    met = rows.join(held, (F.col("refers_to") == F.col("__of")) & (F.col("payload_digest") == F.col("__digest")), "left")
    size = F.when(F.col("record_type") != "revisit", F.col("payload_bytes")).when(F.col("__bytes").isNull(), F.raise_error(F.concat(F.lit("no record of its digest is what this one refers to: "), "record_id")).cast("long")).otherwise(F.col("__bytes"))
    return met.withColumn("payload_bytes", size).drop("__of", "__digest", "__bytes")


def round_trip(df: DataFrame, name: str = "warc", **options) -> DataFrame:
    """Writes ``df`` to packages in the shared folder and reads them back."""
    return read(df.sparkSession, write(df, shared_path(df.sparkSession, name), **options))
