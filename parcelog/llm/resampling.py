"""Importance resampling towards a target distribution, over hashed features.

Words come from the tokenizers library's untrained Regex Split over ASCII-lowered text,
with their offsets; a text's UTF-8 bytes are handed over as one character each, so offsets
count bytes. Features are the windows between an offset pair's start and the end of the
same or a following word; a feature's bucket is the CRC-32 of its words, joined by one
space, modulo ``BUCKETS``. All documents and all target texts fill two bucket histograms,
whose log-ratios are the buckets' gains; a document's weight is the floored mean gain of
its features. Its score adds Gumbel noise that depends on its id and the seed only, so the
documents with the highest scores are a sample without replacement by weight.

Texts are read once: buckets of all features are written as two bytes each, and counted and
summed from there. A histogram's ``BUCKETS`` rows are all that reaches the driver. CRCs are
worked out for a block of words at a time, byte by byte of all its words together.
Ranks come from range partitions of (id, score).

Defined cases: null and empty texts, and texts without words, have no features and weight 0;
a null id's noise is that of an empty one, and it loses ties; rows with equal ids each have
their rank, in any order if their scores are equal; an empty table gives no rows, an empty
target gains that fall with frequency; texts of any length are whole; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from parcelog.operators.ranks import ranked
from parcelog.storage import materialize, small_batches

BUCKETS = 10_000
#: A word of lower-cased text: digits, small letters and all that isn't ASCII (fixed).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST_RUN = 2
#: Words longer than this, in bytes, are given to zlib one by one.
LONG_WORD = 64
#: Words of a block, counted in bytes of text.
BLOCK = 1 << 22


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


TABLE = _crc_table()


def word_offsets(text: bytes, split) -> np.ndarray:
    """(start, end) of each word of lower-cased text, in bytes."""
    words = split.pre_tokenize_str(text.decode("latin-1"))
    return np.fromiter(chain.from_iterable(map(itemgetter(1), words)), dtype=np.int64, count=2 * len(words)).reshape(-1, 2)


def _extend(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC registers after some bytes more: those of ``data`` from start to end."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    size, start, out = size[order], start[order], state[order]
    whole = int(np.searchsorted(-size, -LONG_WORD, side="left"))  # the first so many are long
    for i in range(whole):
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes(), int(out[i] ^ np.uint32(0xFFFFFFFF))) ^ 0xFFFFFFFF
    rest, at = out[whole:], start[whole:]
    steps = np.searchsorted(-size[whole:], -np.arange(int(size[whole]) if whole < len(size) else 0), side="left")
    for j, m in enumerate(steps):  # the first m words have more than j bytes
        rest[:m] = TABLE[(rest[:m] ^ data[at[:m] + j]) & 0xFF] ^ (rest[:m] >> np.uint32(8))
    out[whole:] = rest
    back = np.empty_like(out)
    back[order] = out
    return back


def feature_buckets(data: np.ndarray, offsets: np.ndarray, of: np.ndarray, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all runs of up to ``longest`` words within a text; ``of`` numbers each word's text."""
    start, end = offsets[:, 0], offsets[:, 1]
    state = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    owners, found = [], []
    for run in range(longest):
        if run:  # the words run - 1 places on, where that is the same text
            same = of[: len(state) - 1] == of[run:]
            state = state[:-1]
            state = TABLE[(state ^ np.uint32(0x20)) & 0xFF] ^ (state >> np.uint32(8))
        else:
            same = np.ones(len(state), dtype=bool)
        state = _extend(state, data, start[run:], end[run:])
        owners.append(of[: len(state)][same])
        found.append(((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))[same])
        if not len(state):
            break
    return np.concatenate(owners), np.concatenate(found)


def _features(texts: list[bytes], split) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of words and buckets of the features of each text."""
    offsets = [word_offsets(t, split) for t in texts]
    counts = np.array([len(o) for o in offsets], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    if not counts.sum():
        return counts, [np.zeros(0, dtype=np.uint32) for _ in texts]
    flat = np.concatenate([o + b for o, b in zip(offsets, base, strict=True)])
    of, bucket = feature_buckets(np.frombuffer(b"".join(texts), dtype=np.uint8), flat, np.repeat(np.arange(len(texts)), counts))
    bucket = bucket[np.argsort(of, kind="stable")]
    return counts, np.split(bucket, np.cumsum(np.bincount(of, minlength=len(texts)))[:-1])


def features(df: DataFrame) -> DataFrame:
    """doc_id, n_words and the buckets of all features (unsigned 16-bit, little-endian) of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Regex, pre_tokenizers

        split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        for batch in batches:
            texts = [(t or "").encode().lower() for t in batch["text"]]
            sizes = np.cumsum([len(t) for t in texts])
            for block in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // BLOCK)) + 1):
                counts, found = _features([texts[i] for i in block], split)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[block].to_numpy(), "n_words": counts, "buckets": [b.astype("<u2").tobytes() for b in found]})

    small_batches(df.sparkSession)
    own = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return own.mapInPandas(run, "doc_id string, n_words long, buckets binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: counted in each task, summed by Spark; one row a bucket reaches the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for b in batch["buckets"]:
                count += np.bincount(np.frombuffer(b, dtype="<u2"), minlength=buckets)
        at = np.flatnonzero(count)
        yield pd.DataFrame({"bucket": at, "n": count[at]})

    whole = np.zeros(buckets, dtype=np.int64)
    for row in found.select("buckets").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        whole[row["bucket"]] = row["n"]
    return whole


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000 * log-ratio of each bucket's smoothed shares of the target's features and of the documents'."""
    s_all, t_all = float(own.sum() + len(own)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(own.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from a digest of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of texts with their features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.frombuffer(b, dtype="<u2") for b in batch["buckets"]]
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in own]
            drawn = [noise(None if i is None else int(i), seed) for i in batch["doc_id"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": batch["n_words"], "n_features": [len(b) for b in own], "weight": weight, "score": np.add(weight, drawn, dtype=np.int64)})

    own = found.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no long that can be null
    return own.mapInPandas(run, "doc_id string, n_words long, n_features long, weight long, score long").withColumn("doc_id", F.col("doc_id").cast("long"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """All documents with their number of features, weight and score, and the rank of those drawn: ``percent`` of the
    documents with at least ``least_words`` words. ``target`` has a column text."""
    found = materialize(features(docs), "features")
    aim = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    scored = materialize(scores(found, gains(histogram(found), histogram(aim)), seed), "scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.filter(enough).count() * percent // 100
    order = ranked(scored.filter(enough), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rest = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    whole = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")).unionByName(rest)
    return whole.select("doc_id", "n_features", "weight", "score", "rank")
