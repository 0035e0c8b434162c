"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments of 22, 21 and 21 bits. Of four or
fewer differing bits some two segments hold at most two (pigeonhole). For each two
segments the perfect binary Golay code [23,12,7] decodes the pair as it is, and with
each one bit of it flipped, to the indices of nearby codewords: each fingerprint gets
about ten keys a pair. Two pairs at two bits or fewer have a pair between them at one
bit from either, hence a common key. That holds for any function of a pair, so the number
of fingerprints chooses how many of a pair's segments are decoded (``KEYS``): two give the
fewest keys, of 24 bits, one gives keys of 34 bits, none gives the pairs themselves, so that
a key's members by chance stay few at every size. Tasks then verify the members of a key by
Hamming distance and hand on a spanning forest of the links, never all pairs; keys with very
many members are spread over blocks that meet two by two. Joins of documents with their
fingerprints leave the documents of the most frequent ones where they are.

Equal fingerprints are one node. Defined cases: a null text is an empty one; texts
without words have fingerprint zero and are linked like others; null ids get a row and
count for no component's smallest id (a component of null ids only has a null id);
repeated rows stay; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from parcelog.llm.hot import join_hot
from parcelog.operators.components import connected_components
from parcelog.storage import materialize, small_batches

SHINGLE_WORDS, SEED, MOST_BITS = 4, 42, 4
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (a fixed value).
GENERATOR = 0b101011100011
#: Segments of a pair that are decoded, with the keys of a fingerprint and the bits of a key (all about).
KEYS = ((2, 29, 24 - math.log2(29 / 3)), (1, 96, 34 - math.log2(96 / 3)), (0, 132, 43 - math.log2(132 / 3)))
#: Comparisons that cost as much as a key that is sorted and sent.
COMPARISONS = 200
#: Members of a key that one task compares; keys with more are spread over blocks of this size.
BLOCK = 4096


def fingerprint(text: str | None) -> int:
    """64-bit SimHash over the word shingles of a whole text, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: -SHINGLE_WORDS] + 1]).tolist()
    ends = ends[SHINGLE_WORDS - 1 :].tolist()
    counts, n = np.zeros(64, np.int64), len(ends)
    for lo in range(0, n, 1 << 15):
        own = [joined[a:b] for a, b in zip(starts[lo : lo + (1 << 15)], ends[lo : lo + (1 << 15)], strict=True)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, own, repeat(SEED)), "<u8", len(own))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _remainder(v: int) -> int:
    for k in range(22, 10, -1):
        if v >> k & 1:
            v ^= GENERATOR << (k - 11)
    return v


def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and the error of weight three or less of each remainder."""
    unit = [_remainder(1 << k) for k in range(23)]

    def spread(first: int, width: int) -> np.ndarray:
        out = np.zeros(1 << width, np.uint32)
        for k in range(width):
            out[1 << k : 2 << k] = out[: 1 << k] ^ unit[first + k]
        return out

    leader = np.zeros(2048, np.uint32)
    for weight in (1, 2, 3):
        for at in combinations(range(23), weight):
            r = e = 0
            for k in at:
                r, e = r ^ unit[k], e | 1 << k
            leader[r] = e
    return spread(0, 12), spread(12, 11), leader


LOW, HIGH, LEADER = _golay_tables()


def codeword_index(v: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the one codeword within three bits of each 23-bit value."""
    return (v ^ LEADER[LOW[v & 0xFFF] ^ HIGH[v >> 12]]) >> 11


def decoded_for(n: int) -> int:
    """How many of a pair's segments to decode for n fingerprints: what makes keys and their members' comparisons least."""
    return min(KEYS, key=lambda k: k[1] * (1 + n / 2 ** k[2] / 2 / COMPARISONS))[0]


def keys_of(fps: np.ndarray, decoded: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for all keys of each fingerprint (unsigned), each key once a row."""
    raw, near = [], []
    for first, width in SEGMENTS:
        v = (fps >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
        raw.append((v[:, None] ^ flips[None, :]).astype(np.int64))
        near.append(codeword_index(v[:, None] ^ flips[None, :]).astype(np.int64))
    rows, keys = [], []
    for p, (i, j) in enumerate(combinations(range(3), 2)):
        a, b, width = near[i] if decoded == 2 else raw[i], near[j] if decoded else raw[j], 12 if decoded else 22
        k = np.sort(np.concatenate([a << width | b[:, :1], a[:, :1] << width | b[:, 1:]], axis=1), axis=1)
        new = np.concatenate([np.ones((len(k), 1), bool), k[:, 1:] != k[:, :-1]], axis=1)
        rows.append(np.nonzero(new)[0])
        keys.append(k[new] | p << 44)
    return np.concatenate(rows), np.concatenate(keys)


def forest(fps: np.ndarray, most: int = MOST_BITS) -> list[tuple[int, int]]:
    """Spanning forest (positions) of the graph that links values at ``most`` differing bits or fewer."""
    left, out = np.arange(len(fps)), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            hit = np.full(len(left), -1)
            for f in front:
                open_ = hit < 0
                hit[open_] = np.where(np.bitwise_count(fps[left[open_]] ^ fps[f]) <= most, f, -1)
            got = hit >= 0
            out += zip(hit[got].tolist(), left[got].tolist(), strict=True)
            front, left = left[got], left[~got]
    return out


def _link(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key become links (hot false, u, v), or for keys over the limit (hot true, key, fp)."""

    def emit(hot: bool, u, v) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([hot] * len(u), pa.bool_()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["hot", "u", "v"])

    def linked(fps: np.ndarray) -> pa.RecordBatch:
        pairs = forest(fps.view(np.uint64))
        return emit(False, fps[[a for a, _ in pairs]], fps[[b for _, b in pairs]])

    held_key, held, passing = None, [], False
    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        if held_key is not None and keys[0] != held_key:
            if not passing and sum(map(len, held)) > 1:
                yield linked(np.concatenate(held))
            held_key, held, passing = None, [], False
        # The first run may go on from the batch before, the last may go on in the next.
        inner = np.arange(1 if held_key is not None else 0, len(edges) - 2)
        small = inner[(edges[inner + 1] - edges[inner] <= 8) & (edges[inner + 1] - edges[inner] > 1)]
        if len(small):
            at = np.zeros(len(keys), bool)
            for a, b in zip(edges[small], edges[small + 1], strict=True):
                at[a:b] = True
            for d in range(1, 8):
                i = np.flatnonzero(at[:-d] & at[d:] & (keys[:-d] == keys[d:]))
                i = i[np.bitwise_count((fps[i] ^ fps[i + d]).view(np.uint64)) <= MOST_BITS]
                if len(i):
                    yield emit(False, fps[i], fps[i + d])
        for r in inner[edges[inner + 1] - edges[inner] > 8]:
            own = fps[edges[r] : edges[r + 1]]
            yield emit(True, np.full(len(own), keys[edges[r]]), own) if limit and len(own) > limit else linked(own)
        for r in sorted({0, len(edges) - 2} - set(inner.tolist())):
            own, key = fps[edges[r] : edges[r + 1]], keys[edges[r]]
            if held_key is not None and key != held_key:
                if not passing and sum(map(len, held)) > 1:
                    yield linked(np.concatenate(held))
                held, passing = [], False
            held_key = key
            held.append(own)
            if limit and (passing or sum(map(len, held)) > limit):
                every = np.concatenate(held)
                yield emit(True, np.full(len(every), key), every)
                held, passing = [], True
    if not passing and sum(map(len, held)) > 1:
        yield linked(np.concatenate(held))


def _links(fps: DataFrame, block: int = BLOCK, decoded: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints that keep their connections whole."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(lo, 4096).to_numpy()
                rows, keys = keys_of(own.view(np.uint64), decoded)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows])], names=["key", "fp"])

    found = fps.select("fp").mapInArrow(keyed, "key long, fp long").repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _link(b, block), "hot boolean, u long, v long")
    found = materialize(found, "links")
    links, hot = found.filter("not hot").select("u", "v"), found.filter("hot").select(F.col("u").alias("key"), F.col("v").alias("fp"))
    if not hot.isEmpty():
        blocks = hot.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
        own = hot.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("fp"), "n").cast("int"))
        met = own.select("key", "fp", "b", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
        met = met.select(F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o")).alias("key"), "fp")
        links = links.union(met.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _link(b, None), "hot boolean, u long, v long").select("u", "v"))
    return links


def fingerprints(docs: DataFrame) -> DataFrame:
    """``fp`` (the fingerprint's bits as a signed long) beside doc_id and the text's hash."""
    small_batches(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(map(fingerprint, batch.column(1).to_pylist()), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), batch.column(2)], names=["doc_id", "fp", "text_hash"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(hashed, "doc_id long, fp long, text_hash long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every document; then root (a node of its component) and text_hash."""
    own = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    n_docs, n_nodes = own.count(), nodes.count()
    roots = materialize(connected_components(_links(nodes, decoded=decoded_for(n_nodes))), "roots").withColumnRenamed("node", "fp")
    linked = materialize(nodes.withColumnRenamed("n", "n_docs").join(roots, "fp"), "linked")
    component = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "components")
    of_linked = join_hot(linked, component, "root", n_nodes).select("fp", "root", "component_id")
    of_all = nodes.join(of_linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), "n")
    found = join_hot(own, materialize(of_all, "components-of-nodes"), "fp", n_docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.lower(F.lpad(F.hex("root"), 16, "0")).alias("root"), "text_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: that with the smallest id (a null id only if there is no other; ties by the text's hash).

    The kept rows' keys meet the documents in one shuffle, by the key, which also tells rows that are repeated.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    names = _free(docs, "none_", "id_", "hash_")
    kept = near_duplicates(docs).groupBy("root").agg(F.min(rank).alias("first")).select(*[F.col(f"first.{c}").alias(n) for c, n in zip(("none", "id", "text_hash"), names, strict=True)])
    own = F.col("doc_id").cast("long")
    marked = docs.withColumns(dict(zip(names, (own.isNull(), F.coalesce(own, F.lit(0)), F.coalesce(F.xxhash64("text"), F.lit(0))), strict=True)))
    return marked.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names that ``docs`` doesn't have, made from those given."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out
