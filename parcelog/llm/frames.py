"""Token-ID files: independent zstandard frames with a trailing seek table.

A shard is a run of zstandard frames that any decoder reads. Each frame holds the ids
(little-endian unsigned 32-bit) of one or more whole documents; the last data frame
holds the shard's index (document ids, null marks, token counts). Behind it stands, as
a skippable frame, the seek table of the public seekable format: for each frame its
compressed and decompressed size and the low 32 bits of the XXH64 of its content. A
reader takes the tail, the index and then only the frames of the documents it wants.

``write_token_files`` sorts documents by id over all shards and lets each task write
its own shards, of bounded size and number of documents, below the shared folder; a retried task writes other
files, and the manifest names the ones that count, with the ids that they range over.
``read_token_files`` reads whole shards, ``find_documents`` single documents from the
shards whose range may hold them.

Defined cases: a null text is an empty one (the end id only); null ids come first and
stay null; repeated ids and rows are kept, each with its place (ties by the text's
hash); an empty table has no shards and gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelog.llm.tokens import encoder
from parcelog.storage import scratch_path, small_batches

SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n_tokens", "<u4")])
MANIFEST = "shard int, part int, path string, n_docs long, n_tokens long, first_id long, last_id long"
#: Decompressed bytes after which a frame, and a shard, is closed; a document is never parted.
FRAME_BYTES, SHARD_BYTES = 1 << 17, 1 << 30
#: Documents after which a shard is closed, too: its index is one frame, of 13 bytes a document.
SHARD_DOCUMENTS = 4_000_000


class ShardWriter:
    """Writes one shard; memory holds the open frame and 13 bytes a document."""

    def __init__(self, sink, level: int = 3) -> None:
        self.sink, self.table = sink, []
        self.ids, self.known, self.counts = array("q"), bytearray(), array("I")
        self.parts: list[bytes] = []
        self.size, self.total = 0, 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.sink.write(packed)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def _close_frame(self) -> None:
        if self.parts:
            self._frame(b"".join(self.parts))
            self.parts, self.size = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > FRAME_BYTES:
            self._close_frame()
        self.parts.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.counts.append(len(ids) // 4)

    def id_range(self) -> tuple[int | None, int | None]:
        """The least and the greatest id of documents added in order; none of null ids only."""
        first = self.known.find(1)
        return (self.ids[first], self.ids[-1]) if first >= 0 else (None, None)

    def close(self) -> None:
        self._close_frame()
        index = np.empty(len(self.ids), INDEX)
        index["doc_id"], index["known"], index["n_tokens"] = self.ids, self.known, self.counts
        self._frame(index.tobytes())
        body = np.array(self.table, dtype=ENTRY).tobytes() + FOOTER.pack(len(self.table), 0x80, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class ShardReader:
    """Random access to one shard."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - FOOTER.size)
        n, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - FOOTER.size - n * ENTRY.itemsize)
        self.table = np.frombuffer(source.read(n * ENTRY.itemsize), dtype=ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(self.table["packed"].astype(np.int64))])
        self.zstd = zstandard.ZstdDecompressor()
        self.index = np.frombuffer(self.frame(n - 1), dtype=INDEX)
        self.starts = np.concatenate([[0], np.cumsum(self.index["n_tokens"].astype(np.int64))])
        self.frame_starts = np.concatenate([[0], np.cumsum(self.table["size"][:-1].astype(np.int64))]) // 4

    def frame(self, k: int) -> bytes:
        self.source.seek(int(self.offsets[k]))
        content = self.zstd.decompress(self.source.read(int(self.table["packed"][k])), max_output_size=max(1, int(self.table["size"][k])))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table["check"][k]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def documents(self, rows: Iterable[int]) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start within the shard, ids) of the index rows given in ascending order."""
        at, content = -1, b""
        for r in rows:
            k = int(np.searchsorted(self.frame_starts, self.starts[r], side="right")) - 1
            if k != at:
                at, content = k, self.frame(k)
            a = 4 * int(self.starts[r] - self.frame_starts[k])
            doc = self.index[r]
            yield int(doc["doc_id"]) if doc["known"] else None, int(self.starts[r]), content[a : a + 4 * int(doc["n_tokens"])]

    def find(self, doc_id: int) -> range:
        """Index rows of a document; null ids come first, the others ascend."""
        first = int((self.index["known"] == 0).sum())
        ids = self.index["doc_id"][first:]
        return range(first + int(np.searchsorted(ids, doc_id, "left")), first + int(np.searchsorted(ids, doc_id, "right")))


def open_uri(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path


def write_token_files(docs: DataFrame, directory: str, tokenizer_path: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards below ``directory``; returns the manifest, written there too."""
    small_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, end = TaskContext.get().partitionId(), np.array([end_id], dtype="<u4").tobytes()
        encode, fs, open_, done = encoder(tokenizer_path).encode, None, None, []

        def finish() -> None:
            writer, sink, path = open_
            writer.close()
            sink.close()
            done.append((shard, len(done), path, len(writer.ids), writer.total // 4, *writer.id_range()))

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    if open_ and (open_[0].total + len(ids) + 4 > shard_bytes or len(open_[0].ids) >= shard_documents):
                        finish()
                        open_ = None
                    if not open_:
                        fs, folder = open_uri(directory)
                        fs.create_dir(folder, recursive=True)
                        name = f"shard-{shard:05d}-{len(done):05d}-{uuid.uuid4().hex}.zst"
                        sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
                        open_ = (ShardWriter(sink), sink, f"{directory}/{name}")
                    open_[0].add(doc_id, ids + end)
        if open_:
            finish()
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{directory}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{directory}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start, n_tokens, ids_crc32; ``start`` counts over all shards in order."""
    from pyspark.sql import Window

    # One small row for each shard; the running sum is over shards, not over documents.
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                fs, name = open_uri(path)
                with fs.open_input_file(name) as source:
                    reader = ShardReader(source)
                    out: list[tuple] = []
                    for doc_id, start, ids in reader.documents(range(len(reader.index))):
                        out.append((doc_id, base + start, len(ids) // 4, zlib.crc32(ids)))
                        if len(out) == 8192:
                            yield _rows(out)
                            out = []
                    yield _rows(out)

    return based.select("path", "base").repartitionByRange(max(1, manifest.count()), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(path: str, doc_ids: Sequence[int]) -> list[tuple[int, list[int]]]:
    """Ids of the wanted documents of one shard; only their frames are decompressed."""
    fs, name = open_uri(path)
    with fs.open_input_file(name) as source:
        reader = ShardReader(source)
        rows = sorted(r for d in set(doc_ids) for r in reader.find(d))
        return [(d, np.frombuffer(ids, "<u4").tolist()) for d, _, ids in reader.documents(rows)]


def find_documents(manifest: DataFrame, doc_ids: Sequence[int]) -> list[tuple[int, list[int]]]:
    """Ids of the wanted documents, a few: only shards that may hold one are opened, and only their frames read."""
    wanted = sorted(set(doc_ids))
    holds = F.exists(F.lit(wanted).cast("array<bigint>"), lambda d: d.between(F.col("first_id"), F.col("last_id")))
    paths = [r["path"] for r in manifest.filter(holds).orderBy("shard", "part").select("path").collect()]  # as many as documents, or little more
    return [found for path in paths for found in read_documents(path, wanted)]


def token_files(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` as token-ID files below the shared folder and read them back."""
    return read_token_files(write_token_files(docs, scratch_path(spark, "token-files"), tokenizer_path))
