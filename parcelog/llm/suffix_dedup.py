"""Repeated substrings of at least ``LEAST`` bytes: threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``LEAST`` bytes that covers it also starts in a document with a
smaller id. Equal strings must meet, but no task can index all text, so text is dealt out
by anchors: a string's anchor is its ``GRAM``-byte gram with the least hash, which depends
on nothing else, so equal strings have equal anchors. Consecutive strings with one anchor
form a segment, on average 67 bytes for each 18 bytes of text.

1. Texts are packed into chunks of about ``CHUNK`` bytes, once, compressed.
2. Each chunk's different anchors meet by hash range; those that stand in one document only go.
3. Each chunk sends its different segments that are left, with the smallest id that holds
   each. Anchors with more than ``HOT`` segments send each string under its own hash instead,
   so a passage that a third of all documents hold, before and after whatever, is dealt out by
   its strings, and each comes once from a chunk.
4. Where segments meet, the Burrows-Wheeler transform of those of some anchors is built and
   searched backwards, breadth first: all strings of one length are intervals of sorted
   suffixes, extended by one byte to the left in each round. A boundary that first shows in
   round k parts suffixes with k bytes in common, so common prefixes come by increasing value;
   after ``LEAST`` rounds, what isn't parted shares ``LEAST`` bytes. The smallest id of such an
   interval is returned to the chunks that hold a larger one.
5. Chunks mark the strings that also start in a smaller document, and cut what they cover.

Chunks and segments move as compressed arrays in as many rows as there are (chunk, hash range)
pairs; a task holds one chunk or one range. All steps give the same rows if they are repeated.

Defined cases: null texts are empty; texts below ``LEAST`` bytes stay whole; a null id counts
as larger than all; rows with equal ids are one document to each other, so none takes from
the other; a string that repeats within a document only stays; an empty table gives no rows;
very long texts are scanned in blocks; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from parcelog.storage import materialize, small_batches

LEAST, GRAM = 50, 16
#: Bytes of text of a chunk (more only for a single longer document), of a block that is hashed at once, and for each hash range.
CHUNK, BLOCK, RANGE = 1 << 20, 1 << 17, 1 << 23
#: Bytes whose transform is built at once; one anchor's segments stay together.
TRANSFORM = 3 << 14
HOT = 10_000
LAST_ID = (1 << 63) - 1
#: A byte that UTF-8 never holds; it ends each segment.
END = 0xFF
KEY_BITS = 48
LEVEL = 3
#: What moves: documents of a chunk, and its anchors, those of them that are shared, its segments, and what is found of them.
DOCUMENT = np.dtype([("id", "<i8"), ("no_id", "?"), ("size", "<i8")])
ANCHOR = np.dtype([("key", "u1", KEY_BITS // 8), ("count", "<u2"), ("several", "?")])
SHARED = np.dtype([("key", "u1", KEY_BITS // 8), ("hot", "?")])
SEGMENT = np.dtype([("key", "<u8"), ("start", "<i4"), ("low", "<i8"), ("high", "<i8"), ("size", "<u4"), ("apart", "?")])
FOUND = np.dtype([("start", "<i4"), ("apart", "?"), ("strings", "<u4")])


def _dump(kind: np.dtype, tail: bytes = b"", **columns) -> bytes:
    """Columns one after another, and bytes behind them, compressed."""
    data = [np.ascontiguousarray(columns[name], dtype=kind[name].base).tobytes() for name in kind.names]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([len(columns[kind.names[0]]).to_bytes(8, "little"), *data, tail]))


def _load(kind: np.dtype, blob: bytes) -> tuple[np.ndarray, bytes]:
    data = zstandard.decompress(blob)
    n, at = int.from_bytes(data[:8], "little"), 8
    rows = np.empty(n, dtype=kind)
    for name in kind.names:
        rows[name] = np.frombuffer(data, kind[name].base, n * int(np.prod(kind[name].shape, dtype=int)), at).reshape(n, *kind[name].shape)
        at += n * kind[name].itemsize
    return rows, data[at:]


def _short(key: np.ndarray) -> np.ndarray:
    """The bytes of keys that are used."""
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8]


def _long(short: np.ndarray) -> np.ndarray:
    return np.pad(short, ((0, 0), (0, 8 - KEY_BITS // 8))).reshape(-1).view("<u8").astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - KEY_BITS)


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all grams, whose width is a power of two."""
    h, size = data.astype(np.uint64) + np.uint64(1), 1
    while size < GRAM:
        h, size = (h[:-size] * np.uint64(0x9FB21C651E98DF25)) ^ (h[:-size] >> np.uint64(17)) ^ h[size:], 2 * size
    return _mix(h)


def _string_hashes(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(size):
        h = (h ^ data[at + j]) * np.uint64(0x100000001B3)
    return _mix(h)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several runs."""
    ends = np.cumsum(size)
    out = np.repeat(start - (ends - size), size)
    out += np.arange(len(out))
    return out


def segments(data: np.ndarray, doc: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, anchor) of the segments of texts that lie one after another; ``doc`` numbers each byte's text."""
    starts, ends, anchors = [], [], []
    for base in range(0, max(len(data) - least + 1, 0), BLOCK):
        part, own = data[base : base + BLOCK + least - 1], doc[base : base + BLOCK + least - 1]
        n = len(part) - least + 1
        gram = _grams(part)
        bits = np.uint64(22)  # places within a block; ties of the rest go to the first place
        best = ((gram >> np.uint64(KEY_BITS - 42)) << bits) | np.arange(len(gram), dtype=np.uint64)
        width, size = least - GRAM + 1, 1
        while 2 * size <= width:
            best, size = np.minimum(best[:-size], best[size:]), 2 * size
        if size < width:
            best = np.minimum(best[:n], best[width - size :])
        place = (best & np.uint64((1 << 22) - 1)).astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:n] != own[: n - 1]) | (own[least : n + least - 1] != own[least - 1 : n + least - 2])]))
        stops = np.append(begins[1:], n)
        fits = own[begins] == own[begins + least - 1]
        starts.append(base + begins[fits])
        ends.append(base + stops[fits] + least - 1)
        anchors.append(gram[place[begins[fits]]])
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(anchors)


def _suffix_order(text: np.ndarray, least: int) -> np.ndarray:
    """Rotations of a text ordered by their first bytes, ``least`` or more of them: prefixes grow threefold by ranks in each
    round (twofold in texts above 64 KiB), and ranks and place are sorted as one number as long as they fit."""
    n = len(text)
    bits = max(n - 1, 1).bit_length()
    times = 3 if 4 * bits <= 64 else 2
    packed = (times + 1) * bits <= 64
    size = (64 - bits) // 8 if packed else 8
    own, key = np.concatenate([text, np.resize(text, 8)]).astype(np.uint64), np.zeros(n, dtype=np.uint64)
    for j in range(size):
        key = (key << np.uint64(8)) | own[j : n + j]
    shift, mask, place = np.uint64(bits), np.uint64((1 << bits) - 1), np.arange(n, dtype=np.uint64)
    rank, step = np.empty(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    while True:
        if packed:
            key <<= shift
            key |= place
            key.sort()
            order = (key & mask).astype(np.int64)
            key >>= shift
        else:
            order = np.argsort(key)
            key = key[order]
        if size >= least:
            return order
        np.cumsum(key[1:] != key[:-1], out=step[1:])
        rank[order] = step
        key = rank.copy()
        for k in range(1, times):
            key <<= shift
            key |= np.roll(rank, -k * size)
        size *= times


def common_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of a text's rotations by ``least`` bytes or more, and for each how many bytes it has in common with the one
    before it, as far as that is below ``least`` (else ``least``): breadth-first backward extension on the transform, by
    increasing value. As intervals stop at ``least`` bytes, the order beyond them doesn't matter."""
    n = len(text)
    order = _suffix_order(text, least)
    before = text[order - 1]  # the transform
    by_byte = np.argsort(before, kind="stable")
    mapped, last_same = np.empty(n, dtype=np.int32), np.full(n, -1, dtype=np.int32)
    mapped[by_byte] = np.arange(n)
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    last_same[by_byte[1:][same]] = by_byte[:-1][same]
    common, parted = np.full(n, least, dtype=np.uint8 if least < 256 else np.int32), np.zeros(n + 1, dtype=bool)
    parted[[0, n]] = True
    common[0] = 0
    bounds, recent = np.array([0, n]), np.array([n])  # boundaries, and those found since they were listed
    new = np.zeros(1, dtype=np.int32)
    for k in range(least):
        # Intervals of k bytes that begin at a new boundary; those at older ones were extended before.
        if 8 * len(recent) > len(bounds):
            bounds, recent = np.flatnonzero(parted), np.array([n])
            at = np.flatnonzero(common[bounds[:-1]] == max(k - 1, 0))
            first, stop = bounds[at], bounds[at + 1]
        else:
            first = np.sort(new).astype(np.int64)
            stop = np.minimum(bounds[np.searchsorted(bounds, first, side="right")], recent[np.searchsorted(recent, first, side="right")])
        size = stop - first
        inside = _spread(first, size)
        # The first suffix of an interval behind each byte begins the interval that is one byte longer.
        new = mapped[inside[last_same[inside] < np.repeat(first, size)]]
        new = new[~parted[new]]
        if not len(new):
            break
        parted[new] = True
        common[new] = k
        recent = np.sort(np.concatenate([recent, new]))
    return order, common


def smallest_holders(strings: list[bytes], low: np.ndarray, least: int) -> np.ndarray:
    """For each string and each ``least`` bytes in it, one after another, the smallest of the ids ``low`` of all strings that hold them."""
    text = np.frombuffer(bytes([END]).join(strings) + bytes([END]), dtype=np.uint8)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    order, common = common_prefixes(text, least)
    rank = np.empty(len(text), dtype=np.int64)
    rank[order] = np.arange(len(text))
    at = rank[_spread(np.cumsum(size + 1) - size - 1, size - least + 1)]
    own = np.full(len(text), LAST_ID)
    own[at] = np.repeat(low, size - least + 1)
    begins = np.flatnonzero(common < least)
    least_id = np.minimum.reduceat(own, begins)
    return least_id[(np.cumsum(common < least) - 1)[at]]


class Chunk:
    """Texts one after another, with the ids of their documents."""

    def __init__(self, packed: bytes, least: int) -> None:
        documents, self.text = _load(DOCUMENT, packed)
        self.ids, self.no_id, self.lengths = documents["id"].astype(np.int64), documents["no_id"], documents["size"].astype(np.int64)
        self.least = least
        self.data = np.frombuffer(self.text, dtype=np.uint8)
        self.doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.lengths)
        self.start, self.end, self.anchor = segments(self.data, self.doc, least)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different anchors by value, how many segments each has (65,535 at most), and whether they lie in several documents."""
        order = np.argsort(self.anchor, kind="stable")
        value, first, count = np.unique(self.anchor[order], return_index=True, return_counts=True)
        own = self.ids[self.doc[self.start[order]]]
        several = np.minimum.reduceat(own, first) < np.maximum.reduceat(own, first) if len(first) else np.zeros(0, dtype=bool)
        return value, np.minimum(count, 65_535).astype(np.uint16), several

    def places(self, anchors: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, key, hot) of the segments of some anchors, which ascend; those of hot ones are taken apart into strings."""
        if not len(anchors) or not len(self.start):
            return self.start[:0], self.end[:0], self.anchor[:0], hot[:0]
        at = np.minimum(np.searchsorted(anchors, self.anchor), len(anchors) - 1)
        chosen = anchors[at] == self.anchor
        whole, apart = chosen & ~hot[at], chosen & hot[at]
        each = _spread(self.start[apart], (self.end - self.start)[apart] - self.least + 1)
        key = np.concatenate([self.anchor[whole], _string_hashes(self.data, each, self.least)])
        return np.concatenate([self.start[whole], each]), np.concatenate([self.end[whole], each + self.least]), key, np.arange(len(key)) >= whole.sum()

    def strings(self, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        return [self.text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]

    def different(self, anchors: np.ndarray, hot: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """Different segments of some anchors: their strings, and first places, keys, smallest and largest ids, and hotness."""
        start, end, key, apart = self.places(anchors, hot)
        numbers: dict[tuple[bytes, bool], int] = {}
        pairs = zip(self.strings(start, end), apart.tolist(), strict=True)
        of = np.fromiter((numbers.setdefault(p, len(numbers)) for p in pairs), dtype=np.int64, count=len(start))
        first = np.unique(of, return_index=True)[1]
        own = self.ids[self.doc[start]]
        low, high = np.full(len(first), LAST_ID), np.full(len(first), -LAST_ID - 1)
        np.minimum.at(low, of, own)
        np.maximum.at(high, of, own)
        return [s for s, _ in numbers], [start[first], key[first], low, high, apart[first]]

    def cut(self, start: np.ndarray, apart: np.ndarray, number: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
        """Documents with what is left of them, where so many strings from these places on (and all like them) start in these
        smallest ids."""
        covered = np.zeros(len(self.data) + 1, dtype=np.int32)  # strings that begin at a byte, less those that end before it
        if len(start):
            anchors, first = np.unique(self.anchor[np.searchsorted(self.start, start, side="right") - 1], return_index=True)
            known = {x: i for i, x in enumerate(zip(self.strings(start, start + number + self.least - 1), apart.tolist(), strict=True))}
            at, end, _, own_apart = self.places(anchors, apart[first])
            of = np.fromiter((known.get(p, -1) for p in zip(self.strings(at, end), own_apart.tolist(), strict=True)), dtype=np.int64, count=len(at))
            at, end, of = at[of >= 0], end[of >= 0], of[of >= 0]
            string = _spread(at, end - at - self.least + 1)
            least_id = ids[_spread((np.cumsum(number) - number)[of], number[of])]
            again = string[least_id < self.ids[self.doc[string]]]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + self.least, -1)
        gone = np.cumsum(covered, dtype=np.int32)[:-1] > 0
        base = np.cumsum(self.lengths) - self.lengths
        edges = np.concatenate([[True], (gone[1:] != gone[:-1]) | (self.doc[1:] != self.doc[:-1]), [True]]) if len(gone) else np.zeros(1, dtype=bool)
        runs = np.flatnonzero(edges)
        begin, stop = (runs[:-1][gone[runs[:-1]]], runs[1:][gone[runs[:-1]]]) if len(gone) else (runs[:0], runs[:0])
        parts = np.searchsorted(begin, base)[1:]
        left = np.concatenate([[0], np.cumsum(~gone)])
        kept, cuts = self.data[~gone].tobytes(), left[np.append(base, len(self.data))].tolist()
        shifted = [np.split(x - base[self.doc[begin]], parts) for x in (begin, stop)]
        return pd.DataFrame({
            "doc_id": pd.array(np.where(self.no_id, 0, self.ids), dtype="Int64").copy(), "n_bytes": self.lengths, "starts": shifted[0], "ends": shifted[1],
            "kept": [kept[a:b] for a, b in zip(cuts, cuts[1:], strict=False)],
        }).assign(doc_id=lambda d: d["doc_id"].mask(self.no_id))


def _chunks(docs: DataFrame) -> DataFrame:
    """chunk, bytes, packed: all texts and ids."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def row() -> pd.DataFrame:
            known = [LAST_ID if i is None else int(i) for i in ids]
            packed = _dump(DOCUMENT, b"".join(texts), id=known, no_id=[i is None for i in ids], size=[len(t) for t in texts])
            return pd.DataFrame({"chunk": [number], "bytes": [size], "packed": [packed]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                own = (text or "").encode()
                if texts and size + len(own) > CHUNK:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(own)
                size += len(own)
        if texts:
            yield row()

    small_batches(docs.sparkSession, size=2 * CHUNK)
    own = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")  # pandas has no long that can be null
    return materialize(own.mapInPandas(pack, "chunk long, bytes long, packed binary"), "suffix-chunks")


def _by_range(key: np.ndarray, ranges: int) -> list[tuple[int, np.ndarray]]:
    """Hash ranges and the places of their keys. Keys are hashed once more: as anchors are least hashes, most of them are small."""
    of = ((_mix(key) >> np.uint64(KEY_BITS - 24)) * np.uint64(ranges)) >> np.uint64(24)
    order = np.argsort(of, kind="stable")
    named, first = np.unique(of[order], return_index=True)
    return list(zip(named.tolist(), np.split(order, first[1:]), strict=True)) if len(key) else []


def _rows(columns: str, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns.split())


def _with_chunk(chunks: DataFrame, other: DataFrame, run: Callable[[Chunk, int, list[bytes]], pd.DataFrame], schema: str, least: int) -> DataFrame:
    """``run`` for each chunk with what ``other`` has for it."""

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return run(Chunk(left["packed"].iloc[0], least), int(left["chunk"].iloc[0]), list(right["blob"]))

    return chunks.select("chunk", "packed").groupBy("chunk").cogroup(other.groupBy("chunk")).applyInPandas(both, schema)


def _shared_anchors(chunks: DataFrame, ranges: int, least: int, hot: int) -> DataFrame:
    """chunk, blob: the chunk's anchors that stand in several documents, and whether they have more than ``hot`` segments."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, packed in zip(batch["chunk"], batch["packed"], strict=True):
                value, count, several = Chunk(packed, least).anchors()
                sent = [(r, number, _dump(ANCHOR, key=_short(value[at]), count=count[at], several=several[at])) for r, at in _by_range(value, ranges)]
                yield _rows("range chunk blob", sent)

    def meet(own: pd.DataFrame) -> pd.DataFrame:
        parts = [_load(ANCHOR, b)[0] for b in own["blob"]]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        rows = np.concatenate(parts)
        _, of, in_chunks = np.unique(_long(rows["key"]), return_inverse=True, return_counts=True)
        keep, many = (in_chunks > 1) | (np.bincount(of, weights=rows["several"]) > 0), np.bincount(of, weights=rows["count"]) > hot
        found = zip(own["chunk"], *(np.split(x, cuts) for x in (rows["key"], keep[of], many[of])), strict=True)
        return _rows("chunk blob", [(c, _dump(SHARED, key=v[k], hot=m[k])) for c, v, k, m in found if k.any()])

    sent = chunks.select("chunk", "packed").mapInPandas(send, "range long, chunk long, blob binary")
    return sent.groupBy("range").applyInPandas(meet, "chunk long, blob binary")


def _shared_segments(chunks: DataFrame, shared: DataFrame, ranges: int, least: int) -> DataFrame:
    """range, chunk, blob: a chunk's different segments with shared anchors."""

    def send(chunk: Chunk, number: int, blobs: list[bytes]) -> pd.DataFrame:
        rows = []
        if blobs:
            anchors = np.concatenate([_load(SHARED, b)[0] for b in blobs])
            value = _long(anchors["key"])
            order = np.argsort(value)
            strings, (start, key, low, high, apart) = chunk.different(value[order], anchors["hot"][order])
            for r, at in _by_range(key, ranges):
                own = [strings[i] for i in at.tolist()]
                blob = _dump(SEGMENT, b"".join(own), key=key[at], start=start[at], low=low[at], high=high[at], size=[len(s) for s in own], apart=apart[at])
                rows.append((r, number, blob))
        return _rows("range chunk blob", rows)

    return _with_chunk(chunks, shared, send, "range long, chunk long, blob binary", least)


def _expand(own: pd.DataFrame, least: int) -> pd.DataFrame:
    """Of the segments that meet in a hash range: those, for each chunk, whose strings start in smaller documents, with their ids."""
    numbers: dict[bytes, int] = {}
    parts, of = [], []
    for blob in own["blob"]:
        segment, text = _load(SEGMENT, blob)
        ends = np.cumsum(segment["size"], dtype=np.int64).tolist()
        parts.append(segment)
        of.append(np.array([numbers.setdefault(text[e - n : e], len(numbers)) for e, n in zip(ends, segment["size"].tolist(), strict=True)], dtype=np.int64))
    flat, rows = np.concatenate(of), np.concatenate(parts)
    least_id, keys = np.full(len(numbers), LAST_ID), np.zeros(len(numbers), dtype=np.uint64)
    np.minimum.at(least_id, flat, rows["low"])
    keys[flat] = rows["key"]
    strings = list(numbers)
    # Segments of one key stay together; many keys share a transform.
    order = np.argsort(keys, kind="stable")
    sizes = np.cumsum([len(strings[i]) for i in order.tolist()])
    key_ends = np.flatnonzero(np.append(keys[order][1:] != keys[order][:-1], True)) + 1
    full = sizes[key_ends - 1] // TRANSFORM
    groups = np.split(order, key_ends[:-1][np.diff(full) > 0])
    ids = np.concatenate([smallest_holders([strings[i] for i in at.tolist()], least_id[at], least) for at in groups])
    count = np.array([len(s) - least + 1 for s in strings])
    first = np.empty(len(strings), dtype=np.int64)
    first[order] = np.cumsum(count[order]) - count[order]
    smallest = np.empty(len(strings), dtype=np.int64)
    smallest[order] = np.minimum.reduceat(ids, first[order])
    out = []
    for chunk, mine, segment in zip(own["chunk"], of, parts, strict=True):
        found = np.flatnonzero(smallest[mine] < segment["high"])
        if len(found):
            own_count = count[mine[found]]
            held = ids[_spread(first[mine[found]], own_count)]
            blob = _dump(FOUND, held.astype("<i8").tobytes(), start=segment["start"][found], apart=segment["apart"][found], strings=own_count)
            out.append((chunk, blob))
    return _rows("chunk blob", out)


def deduplicate(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, ``starts`` and ``ends`` (bytes) of what is removed of each document, and ``kept``, the remaining bytes."""
    if least < GRAM + 1:
        raise ValueError(f"strings must have more than {GRAM} bytes")
    chunks = _chunks(docs)
    ranges = min(max((chunks.agg(F.sum("bytes")).first()[0] or 0) // RANGE, 1), 1 << 24)

    def cut(chunk: Chunk, _: int, blobs: list[bytes]) -> pd.DataFrame:
        if not blobs:
            return chunk.cut(*np.zeros((4, 0), dtype=np.int64))
        rows, ids = zip(*(_load(FOUND, b) for b in blobs), strict=True)
        found = np.concatenate(rows)
        return chunk.cut(found["start"].astype(np.int64), found["apart"], found["strings"].astype(np.int64), np.frombuffer(b"".join(ids), "<i8"))

    met = _shared_segments(chunks, _shared_anchors(chunks, ranges, least, hot), ranges, least)
    found = met.groupBy("range").applyInPandas(lambda own: _expand(own, least), "chunk long, blob binary")
    return _with_chunk(chunks, found, cut, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary", least)


def digests(found: DataFrame) -> DataFrame:
    """Sizes and digests of deduplicated documents."""
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
