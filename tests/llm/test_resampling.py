"""Importance resampling against a plain version of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from parcelog.llm import resampling

from .util import ODD, docs


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(rows, target, percent=25, least_words=20, seed=7):
    own = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for *_, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    scored = []
    for i, n, f in own:
        weight = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((x for x in scored if x[1] >= least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = eligible[: percent * len(eligible) // 100]
    ranks = {x[0]: k for k, x in enumerate(drawn, 1)}
    return sorted([(i, n, w, s, ranks.get(i) if k >= least_words else None) for i, k, n, w, s in scored], key=repr)


def found(spark, rows, target, **settings):
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(map(tuple, resampling.resample(docs(spark, rows), aim, **settings).collect()), key=repr)


TARGET = ["Which words matter to us? These words do.", None, "", "ÉCOLE École 12 twelve"]


def corpus(n=80):
    words = "these words matter TO us école 12 a-b x_y été don't 字 twelve".split()
    return [(i, " ".join(words[(i * k) % len(words)] + (" \t\n" if k % 7 == 0 else "") for k in range(1 + i % 50))) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    rows = [*corpus(), (1000, "long" * 40 + " and " + "é" * 100 + " again"), (None, "no id " * 12), (1001, None), (1002, "?!.")]
    want = brute(rows, TARGET)
    assert found(spark, rows, TARGET) == want
    monkeypatch.setattr(resampling, "BLOCK", 100)
    monkeypatch.setattr(resampling, "LONG_WORD", 3)
    assert found(spark, rows, TARGET) == want


def test_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in ODD]
    unique = {r[0] for r in rows if [x[0] for x in rows].count(r[0]) == 1}
    assert [r for r in found(spark, rows, []) if r[0] in unique] == [r for r in brute(rows, []) if r[0] in unique]
    assert found(spark, [], TARGET) == []
    twice = found(spark, [(5, "w " * 30)] * 4, TARGET, percent=50)
    assert sorted(r[4] or 0 for r in twice) == [0, 0, 1, 2]


def test_clashing_names(spark):
    rows = corpus(40)
    wide = docs(spark, rows).withColumns({c: F.lit("x") for c in ("rank", "score", "buckets", "n_words", "bucket")})
    aim = spark.createDataFrame([(t, 1) for t in TARGET], "text string, doc_id long")
    assert sorted(map(tuple, resampling.resample(wide, aim).collect()), key=repr) == brute(rows, TARGET)
