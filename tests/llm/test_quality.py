import math
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from parcelog.llm import quality
from tests.llm.util import ODD, docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    documents, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.scores(documents, labels)
    assert got.count() == documents.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9
    assert np.mean([r.predicted for r in held if r.quality == 1]) >= 0.95


def test_held_out_labels_do_not_matter(spark):
    documents, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(300), spark.read.parquet(f"{SF}/labels.parquet")
    lied = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(documents, labels), quality.train(documents, lied)
    assert (a.good, a.bad, a.slope, a.shift, a.prior) == (b.good, b.bad, b.slope, b.shift, b.prior)


def test_odd_documents(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    table = docs(spark, [(i, ("fine prose of words " if i % 2 else "### %% || $$ ") * 30) for i in range(10, 40)] + ODD).withColumn("score", F.lit("mine"))
    rows = quality.scores(table, labels).collect()
    assert len(rows) == 30 + len(ODD)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id and r.doc_id >= 10)
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns and {r.score for r in kept.collect()} == {"mine"}
    for own, share in ((labels.limit(0), 0.5), (labels.filter("quality = 1"), pytest.approx(1, abs=0.05))):
        assert {r.score == share for r in quality.scores(table, own).collect()} == {True}
    assert quality.scores(docs(spark, []), labels).count() == 0


def test_curve_finds_the_odds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(3 * x)))).astype(float)
    slope, shift = quality._curve(x, y)
    assert slope == pytest.approx(3, abs=0.4) and shift == pytest.approx(0, abs=0.2)


def test_scores_are_calibrated_on_held_out_rows(spark):
    sf = SF.replace("0.01", "0.1")
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = quality.scores(documents, labels).join(labels, "doc_id").filter("held_out").toPandas()
    score, label = held["score"].to_numpy(), held["quality"].to_numpy()
    of = np.minimum((score * 10).astype(int), 9)
    error = sum((of == k).mean() * abs(score[of == k].mean() - label[of == k].mean()) for k in range(10) if (of == k).any())
    assert len(held) > 1000 and error <= 0.02
    assert (held["predicted"] == held["quality"]).mean() >= 0.975


def test_scores_equal_brute_force(spark):
    documents, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(200), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(documents, labels)
    for r in quality.score(documents, model).collect():
        sizes = {}
        for name, raw in (("good", model.good), ("bad", model.bad)):
            data, known = (r.text or "").encode(), zstandard.ZstdCompressionDict(raw)
            sizes[name] = 0
            for a in range(0, len(data), 512):
                packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)
                sizes[name] += len(packer.compress(data[a : a + 512]))
        x = (sizes["bad"] - sizes["good"]) / (sizes["bad"] + sizes["good"]) if sizes["good"] else 0.0
        trust = len(r.text or "") / (len(r.text or "") + 100)
        odds = model.slope * trust * x + model.length_slope * trust + model.shift
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-3)


def test_the_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    """A labelled id that thousands of documents bear brings one text, and weighs as much as any other."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] * 3, "doc_id long, quality int")
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 2]
    rows = [(i, ("fine prose of words " if i % 2 else "### %% || $$ ") * (1 + i % 9)) for i in range(400)]
    repeated = rows + [(ids[0], f"copy number {k} ### %%") for k in range(5000)]
    seen = []
    curve = quality._curve
    monkeypatch.setattr(quality, "_curve", lambda x, y: seen.append(len(y)) or curve(x, y))
    model = quality.train(docs(spark, repeated), labels, sample_rows=50)
    assert seen == [100] and model.good and model.bad
    assert quality.scores(docs(spark, repeated), labels).count() == len(repeated)
