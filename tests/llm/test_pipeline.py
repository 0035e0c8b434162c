import re
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as c
from parcelog.llm import decontaminate, quality, secrets
from parcelog.storage import materialize
from tests.llm.test_simhash import brute_fingerprint
from tests.llm.util import ODD, docs

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    columns, table, kept = start.columns, start, []
    for name, stage in c.STAGES:
        table = materialize(stage(spark, table, SF), name)
        kept.append(table)
    assert all(t.columns == columns for t in kept[:-1])
    texts = {r.doc_id: r.text for r in start.collect()}

    scores = {r.doc_id: r.predicted for r in quality.scores(start, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = {i for i in texts if scores[i]}
    assert {r.doc_id for r in kept[0].collect()} == good and 0 < len(good) < len(texts)

    fps = {i: brute_fingerprint(texts[i]) for i in sorted(good)}
    root = dict(zip(fps, fps))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    single = {find(i) for i in fps}
    assert {r.doc_id for r in kept[1].collect()} == single

    items = [decontaminate.normalise(r.text).decode() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i in single if any(f" {x} " in f" {decontaminate.normalise(texts[i]).decode()} " for x in items if x)}
    clean = {r.doc_id for r in kept[2].collect()}
    assert exact and not clean & exact and len(single - clean) <= len(exact) + 2

    masked = {r.doc_id: r for r in kept[3].collect()}
    assert masked.keys() == clean
    for i, r in masked.items():
        assert not re.search("[0-9a-f]{24,}", r.text) and r.n_chars == len(r.text)
        assert ("[secret]" in r.text) or r.text == texts[i]
    assert Counter(r.doc_id for r in kept[4].filter("piece = 0").collect()) == Counter(clean)
    assert c.run(spark, SF).count() == kept[4].count()


def test_stages_on_odd_and_empty_documents(spark):
    for rows in (ODD, []):
        table = docs(spark, rows).withColumn("leaks_own", F.lit(1))
        for name, stage in c.STAGES[:-1]:
            table = materialize(stage(spark, table, SF), f"odd-{name}")
            assert table.columns[-1] == "leaks_own"
        c.STAGES[-1][1](spark, table, SF).collect()
