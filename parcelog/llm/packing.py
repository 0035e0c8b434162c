"""Best-fit packing of documents into sequences by minimum bin slack.

Only the lengths matter for packing, and there are at most ``capacity`` of them: Spark
counts pieces by length, the driver plans bins over that bounded histogram, and tasks
place pieces by length and rank. For each bin, bitset subset-sum dynamic programming
over the available lengths (the longest one left is taken first) finds the fullest
feasible combination; it is taken out as often as the counts allow.

Ranks within a length come from counts of (length, bucket) and places within a bucket,
so that a length which a third of the pieces share is still ranked by many tasks.

Defined cases: a null text is an empty one (a single end id); only documents longer
than the capacity are cut, into full pieces and a rest; repeated rows and null ids are
packed like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parcelog.llm.tokens import encoder
from parcelog.storage import materialize, small_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
#: Pieces of one length and bucket, about; and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 64


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of available lengths, the longest among them, that fills a bin most."""
    longest = max(counts)
    room = capacity - longest
    goal, reach, steps = 1 << room, 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        times = 1
        while left > 0 and not reach & goal:
            take = min(times, left)
            steps.append((reach, length, take))
            reach |= reach << (length * take) & (2 * goal - 1)
            left -= take
            times *= 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, Counter({longest: 1})
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            used[length] += take
            at -= length * take
    return dict(used)


def plan_bins(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Segments (length, rank, uses, first bin, offset): pieces of a length from that rank on go,
    ``uses`` to a bin, to the bins from the first on, from that offset on."""
    counts = {k: n for k, n in counts.items() if n}
    ranks: Counter[int] = Counter()
    segments, bins = [], 0
    while counts:
        used = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in used.items())
        offset = 0
        for length, n in used.items():
            segments.append((length, ranks[length], n, bins, offset))
            ranks[length] += n * times
            offset += n * length
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        bins += times
    return np.array(sorted(segments), dtype=np.int64).reshape(-1, 5)


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of each document's ids: doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).encode, np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, out = batch.slice(lo, 256), []
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for i, a in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[a : a + 4 * capacity]
                        out.append((doc_id, i, a // 4, len(piece) // 4, zlib.crc32(piece)))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(columns)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def place_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Sequence and offset of each piece; ``pieces`` is read more than once and so should be a table."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    segments = plan_bins(histogram, capacity)
    buckets = max(LEAST_BUCKETS, sum(histogram.values()) // BUCKET_ROWS)
    keys = ["length", "bucket"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    firsts = dealt.groupBy(*keys).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(*keys).orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("place", F.row_number().over(within) - 1).join(firsts, keys).select(*[c.split()[0] for c in PIECES.split(", ")], (F.col("first") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = segments[:, 0] << 44 | segments[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            own = segments[np.searchsorted(starts, length << 44 | rank, side="right") - 1]
            nth = rank - own[:, 1]
            sequence, offset = own[:, 3] + nth // own[:, 2], own[:, 4] + nth % own[:, 2] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PLACED)


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens."""
    return place_pieces(materialize(cut_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
