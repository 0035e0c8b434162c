"""Quality classifier: size under zstandard dictionaries of good and of bad text.

Texts are compressed in chunks of about ``CHUNK`` bytes with a dictionary built from
text labelled good, and with one from text labelled bad. The normalised difference
(size with the bad dictionary less size with the good one, by their sum) and how far a
text's length lets it be trusted are the inputs of a logistic curve, fitted without class
weights on other labelled rows, so that the score is the share of label 1 to expect among
texts of that score: on held-out rows of sf0.1 the expected calibration error is below 0.02.

The classifier is fitted on a bounded sample: of each class the ``SAMPLE_ROWS`` rows
with the smallest hash of doc_id for the dictionaries, of both classes together twice as
many for the curve, and of the former the ``SAMPLE_CHUNKS`` chunks with the smallest hash. Scoring covers all rows
and whole texts. Rows whose crc32 of the id's digits is 1 modulo 3 are held out.

Defined cases: empty and null texts score as a difference of zero does; null labels are
not learnt from; an id with both labels counts once with each, and of several
documents with one id the text with the smallest hash is learnt from; null ids are scored and never
labelled or held out; if a class has no labelled rows there is nothing to tell apart
and the score is the share of label 1 (one half without any label); repeated rows stay;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from parcelog.storage import materialize, small_batches

CHUNK = 512
LEVEL = 3
DICTIONARY_BYTES = 112 << 10
#: Length at which the difference of a text counts half as much as that of a very long one.
TRUST_CHARS = 100
SAMPLE_ROWS = 3000
SAMPLE_CHUNKS = 6000


@dataclass
class Model:
    """Dictionaries of the two classes, and log-odds: slope * trust * x + length_slope * trust + shift; ``prior`` without dictionaries."""

    good: bytes | None
    bad: bytes | None
    slope: float = 0.0
    length_slope: float = 0.0
    shift: float = 0.0
    prior: float = 0.0

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
        return [zstandard.ZstdCompressor(dict_data=_prepared(d), **options) for d in (self.bad, self.good)]


def _prepared(raw: bytes) -> zstandard.ZstdCompressionDict:
    found = zstandard.ZstdCompressionDict(raw)
    found.precompute_compress(level=LEVEL)
    return found


def chunks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[a : a + CHUNK] for a in range(0, len(data), CHUNK)]


def difference(text: str | None, compressors: list[zstandard.ZstdCompressor]) -> float:
    """Normalised difference of the sizes of all chunks of a text; more is better."""
    bad, good = (sum(len(c.compress(x)) for x in chunks(text)) for c in compressors)
    return (bad - good) / (bad + good) if bad + good else 0.0


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _differences(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with the column ``difference``."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressors = shared.value.compressors()
        for texts in batches:
            yield pa.array([difference(t.as_py(), compressors) for t in texts], pa.float64())

    return df.withColumn("difference", F.arrow_udf(sizes, "double").asNondeterministic()("text"))


def _trust(size):
    """From 0 for empty texts to 1 for very long ones; takes columns and arrays."""
    return size / (size + TRUST_CHARS)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression of y on x (a column for each input) by Newton steps with a little shrinkage: slopes, then shift."""
    x = x.reshape(len(y), -1)
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    design = np.column_stack([x / scale, np.ones(len(y))])
    shrink = np.append(np.full(x.shape[1], 0.1 / len(y)), 1e-9)  # little beside thousands of rows, bounds where a few are parted
    beta = np.zeros(design.shape[1])
    loss = lambda b: np.mean(np.logaddexp(0, design @ b) - y * (design @ b)) + shrink @ b**2 / 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) / len(y) - shrink * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design / len(y) + np.diag(shrink)
        step = np.linalg.solve(hessian, gradient)
        while np.abs(step).max() >= 1e-9 and loss(beta + step) > loss(beta):
            step /= 2
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return *(float(b) for b in beta[:-1] / scale), float(beta[-1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chunks: int = SAMPLE_CHUNKS) -> Model:
    """Fit on labelled rows that aren't held out: remainder 0 gives the dictionaries, 2 the curve."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)").filter(~held_out())
    labels = labels.distinct()  # an id counts once for each label that it has
    labels = labels.withColumn("part", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3).cast("int")).withColumn("order", F.xxhash64("doc_id"))
    counts = {(r["part"], r["quality"]): r["n"] for r in labels.groupBy("part", "quality").agg(F.count("*").alias("n")).collect()}
    good, bad = (sum(n for (_, q), n in counts.items() if q == c) for c in (1, 0))
    if not good or not bad:
        p = (good + 0.5) / (good + bad + 1)
        return Model(None, None, prior=float(np.log(p / (1 - p))))
    parts = [labels.filter("part = 0 and quality = 0"), labels.filter("part = 0 and quality = 1"), labels.filter("part = 2")]
    chosen = [own.orderBy("order", "doc_id").limit(n) for own, n in zip(parts, (sample_rows, sample_rows, 2 * sample_rows), strict=True)]
    sample = chosen[0].union(chosen[1]).union(chosen[2]).select("doc_id", "quality", "part")
    # Of documents with one id, the text with the smallest hash counts: four times sample_rows at most, and no id outweighs another.
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.xxhash64("text").alias("hash"), "text").alias("own"))
    texts = own.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality", "part").agg(F.min("own").alias("own"))
    texts = materialize(texts.select("doc_id", "own.text", "quality", "part"), "labelled-sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(q, c) for t, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for c in chunks(t)]
            yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())], names=["quality", "chunk"])

    pieces = texts.filter("part = 0").select("text", "quality").mapInArrow(cut, "quality int, chunk binary").withColumn("order", F.xxhash64("chunk"))
    dictionaries = []
    for q in (1, 0):
        own = [bytes(r["chunk"]) for r in pieces.filter(F.col("quality") == q).orderBy("order", "chunk").limit(sample_chunks).collect()]
        dictionaries.append(_dictionary(own))
    model = Model(*dictionaries, prior=float(np.log(good / bad)))
    scored = _differences(texts.filter("part = 2").select("text", "quality"), model).select("difference", F.coalesce(F.length("text"), F.lit(0)).alias("size"), "quality").toPandas()  # twice sample_rows at most; classes keep their share
    if scored["quality"].nunique() == 2:
        trust = _trust(scored["size"].to_numpy(float))
        model.slope, model.length_slope, model.shift = _curve(np.column_stack([trust * scored["difference"].to_numpy(float), trust]), scored["quality"].to_numpy(float))
    else:  # no second part to fit the curve on
        model.slope = 50.0
    return model


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the raw samples where they are too few to train one."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) or b" ")[-DICTIONARY_BYTES:]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from one half on)."""
    if model.good and model.bad:
        trust = _trust(F.coalesce(F.length("text"), F.lit(0)).cast("double"))
        odds = model.slope * trust * F.col("difference") + model.length_slope * trust + model.shift
        scored = _differences(docs, model).withColumn("score", 1 / (1 + F.exp(-odds))).drop("difference")
    else:
        scored = docs.withColumn("score", F.lit(1 / (1 + math.exp(-model.prior))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(own, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    names = {c: f"{c}_own" for c in docs.columns if c.lower() in ("score", "predicted", "difference")}
    kept = score(docs.withColumnsRenamed(names), train(docs, labels)).filter("predicted = 1").drop("score", "predicted")
    return kept.withColumnsRenamed({v: k for k, v in names.items()})
