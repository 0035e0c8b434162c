"""WARC records in ZIP-packaged archives, read by ranges without extraction.

An archive is a ZIP whose members are stored, not compressed: ``archive/data.warc.gz``,
one gzip member a record, and ``indexes/index.cdxj``, a line a record with its place in
the former. A reader takes the end record from the file's tail, follows the ZIP64
locator where sizes call for it, parses the central directory, finds where a member's
bytes begin from its local header, and then reads single records by range.

``archive_pages`` writes a record for each page: of pages with equal payloads of at
least 100 bytes that with the smallest page_id is a response and the others revisit it;
smaller payloads are all responses. Tasks write their own archives below the shared
folder; a retried task writes another file, and the manifest names those that count.

Defined cases: a null html is an empty payload; pages with equal ids and payloads at
the smallest id are all responses; null ids come after all others, revisit like others,
and are responses if their payload has no other id; an empty table gives no archives
and no rows; columns other than page_id, url and html are not read, a null url is empty.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelog.llm.frames import open_uri
from parcelog.llm.hot import join_hot
from parcelog.storage import materialize, scratch_path, small_batches

LEAST_BYTES = 100
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Signatures of ZIP structures (fixed values): local header, central entry, end record, ZIP64 end record and its locator.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
MOST32, MOST16 = 0xFFFFFFFF, 0xFFFF
MANIFEST = "shard int, path string, n_records long"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class ZipWriter:
    """Stored members one after another; sizes are always written in ZIP64 form, so that members can be streamed."""

    def __init__(self, sink) -> None:
        self.sink, self.at, self.entries = sink, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 8, 0, 0, 33, 0, MOST32, MOST32, len(self.name), len(extra)) + self.name + extra)

    def write(self, data: bytes) -> int:
        """Append to the open member; returns where in the member the data begin."""
        at = self.size
        self._put(data)
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        return at

    def end(self) -> None:
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))  # data descriptor
        self.entries.append((self.name, self.start, self.crc, self.size))

    def close(self) -> None:
        first = self.at
        for name, start, crc, size in self.entries:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 8, 0, 0, 33, crc, MOST32, MOST32, len(name), len(extra), 0, 0, 0, 0, MOST32) + name + extra)
        size, n, end64 = self.at - first, len(self.entries), self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, first))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, MOST16, MOST16, MOST32, MOST32, 0))


class ZipReader:
    """Members of a ZIP by range reads; plain and ZIP64 directories."""

    def __init__(self, source) -> None:
        self.source, self.size = source, source.size()
        tail_at = max(0, self.size - (1 << 16) - 22)
        tail = self._read(tail_at, self.size - tail_at)
        at = tail.rfind(struct.pack("<I", END))
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(struct.pack("<I", END), 0, at)
        if at < 0:
            raise ValueError("no end record")
        n, size, first = struct.unpack_from("<HII", tail, at + 10)
        if MOST16 == n or MOST32 in (size, first):
            signature, _, end64, _ = struct.unpack("<IIQI", self._read(tail_at + at - 20, 20))
            if signature != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            record = self._read(end64, 56)
            if struct.unpack_from("<I", record)[0] != END64:
                raise ValueError("no ZIP64 end record")
            n, size, first = struct.unpack_from("<QQQ", record, 32)
        self.members = dict(self._directory(self._read(first, size), n))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _directory(self, data: bytes, n: int) -> Iterator[tuple[str, dict]]:
        at = 0
        for _ in range(n):
            signature, _, _, flags, method, _, _, crc, packed, size, n_name, n_extra, n_comment, _, _, _, start = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, at)
            if signature != CENTRAL:
                raise ValueError("damaged central directory")
            name, extra = data[at + 46 : at + 46 + n_name], data[at + 46 + n_name : at + 46 + n_name + n_extra]
            at += 46 + n_name + n_extra + n_comment
            k = 0
            while k + 4 <= len(extra):
                tag, length = struct.unpack_from("<HH", extra, k)
                if tag == 1:  # only the fields that don't fit, in this order
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                    size, packed, start = (next(wide) if v == MOST32 else v for v in (size, packed, start))
                k += 4 + length
            yield name.decode("utf-8" if flags & 1 << 11 else "cp437"), {"method": method, "crc": crc, "packed": packed, "size": size, "start": start}

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many they are."""
        member = self.members[name]
        if member["method"]:
            raise ValueError(f"{name} isn't stored; it can't be read by ranges")
        header = self._read(member["start"], 30)
        signature, n_name, n_extra = struct.unpack_from("<I", header)[0], *struct.unpack_from("<HH", header, 26)
        if signature != LOCAL:
            raise ValueError("no local header")
        return member["start"] + 30 + n_name + n_extra, member["size"]

    def read(self, name: str, at: int = 0, size: int | None = None) -> bytes:
        begin, whole = self.place(name)
        return self._read(begin + at, min(whole - at, whole if size is None else size))


def record_bytes(kind: str, page_id: int | None, url: str, payload: bytes, n_bytes: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed; a revisit has the response's HTTP head and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        lines[2:2] = [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in top.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    return fields, http, payload


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, n_bytes, record_type and refers_to."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "n_bytes": F.octet_length("html").cast("long")})
    # Only payloads that occur more than once; html stays out of the grouping, and pages of frequent payloads stay where they are.
    groups = own.filter(F.col("n_bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first", "n")
    joined = join_hot(own, materialize(groups, "payloads"), "digest", pages.count(), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("html"), "digest", "n_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, directory: str, records: int = 20_000) -> DataFrame:
    """Write every page's record to archives of at most ``records`` records; returns the manifest, written there too."""
    small_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, done, open_ = TaskContext.get().partitionId(), [], None

        def finish() -> None:
            archive, sink, index, path = open_
            archive.end()
            archive.begin(INDEX)
            archive.write("".join(index).encode())
            archive.end()
            archive.close()
            sink.close()
            done.append((shard, path, len(index)))

        for batch in batches:
            for row in batch.to_pylist():
                if open_ and len(open_[2]) >= records:
                    finish()
                    open_ = None
                if not open_:
                    fs, folder = open_uri(directory)
                    fs.create_dir(folder, recursive=True)
                    name = f"pages-{shard:05d}-{uuid.uuid4().hex}.wacz"
                    sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    open_ = (ZipWriter(sink), sink, [], f"{directory}/{name}")
                    open_[0].begin(RECORDS)
                data = gzip.compress(record_bytes(row["record_type"], row["page_id"], row["url"], row["html"].encode(), row["n_bytes"], row["digest"], row["refers_to"]), 6, mtime=0)
                at = open_[0].write(data)
                open_[2].append(f"{' '.join(row['url'].split()) or '-'} 19700101000000 " + json.dumps({"offset": at, "length": len(data), "page_id": row["page_id"]}) + "\n")
        if open_:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.string(), pa.int64()), strict=True)], names=["shard", "path", "n_records"])

    with_record_types(pages).mapInArrow(write, MANIFEST).write.parquet(f"{directory}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{directory}/manifest")


def records_of(source) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """All records of an archive, each by a range read at the place that the index names."""
    archive = ZipReader(source)
    begin, _ = archive.place(RECORDS)
    for line in archive.read(INDEX).decode().splitlines():
        entry = json.loads(line[line.rindex("{") :])
        source.seek(begin + entry["offset"])
        yield parse_record(gzip.decompress(source.read(entry["length"])))


def read_record(path: str, page_id: int) -> tuple[dict[str, str], dict[str, str], bytes] | None:
    """The record of one page of an archive; no other record is read."""
    fs, name = open_uri(path)
    with fs.open_input_file(name) as source:
        archive = ZipReader(source)
        for line in archive.read(INDEX).decode().splitlines():
            entry = json.loads(line[line.rindex("{") :])
            if entry["page_id"] == page_id:
                return parse_record(gzip.decompress(archive.read(RECORDS, entry["offset"], entry["length"])))
    return None


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record; payloads are checked against their digests."""

    def number(field: str) -> int | None:
        digits = field.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = open_uri(path)
                out = []
                with fs.open_input_file(name) as source:
                    for fields, http, payload in records_of(source):
                        digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError("a payload doesn't match its digest")
                        out.append((number(fields["warc-record-id"]), int(http["content-length"]), digest, kind, number(fields.get("warc-refers-to", ""))))
                columns = zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return manifest.select("path").repartitionByRange(max(1, manifest.count()), "path").mapInArrow(read, PAGES)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below the shared folder and read them back."""
    return read_archives(write_archives(pages, scratch_path(spark, "archives")))
