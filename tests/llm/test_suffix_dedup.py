"""Repeated substrings against brute force over all strings of LEAST bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelog.llm import suffix_dedup

from .util import ODD, docs


def brute(rows, least=50):
    """Removed spans and kept bytes of each row; a null id is the largest."""
    rank = lambda i: (1, 0) if i is None else (0, i)
    first: dict[bytes, tuple] = {}
    texts = [(t or "").encode() for _, t in rows]
    for (i, _), t in zip(rows, texts, strict=True):
        for p in range(len(t) - least + 1):
            own = t[p : p + least]
            first[own] = min(first.get(own, rank(i)), rank(i))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - least + 1):
            if first[t[p : p + least]] < rank(i):
                gone[p : p + least] = b"\1" * least
        spans, p = [], 0
        while p < len(t):
            e = p
            while e < len(t) and gone[e]:
                e += 1
            if e > p:
                spans.append((p, e))
            p = max(e, p + 1)
        out.append((i, len(t), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def found(spark, rows, **settings):
    got = suffix_dedup.deduplicate(docs(spark, rows), **settings).collect()
    return sorted(((r.doc_id, r.n_bytes, list(zip(r.starts, r.ends, strict=True)), bytes(r.kept)) for r in got), key=repr)


def corpus(seed, n=120):
    """Texts of few words, with copies, shared passages in changing surroundings, loops and repeated ids."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé字") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [text(12) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = rng.randrange(6)
        own = text(rng.randint(0, 60))
        if kind == 0 and rows:
            own = rng.choice(rows)[1]
        elif kind == 1:
            own = text(5) + rng.choice(passages) + text(5) + rng.choice(passages)
        elif kind == 2:
            own = rng.choice("ab") * rng.randint(0, 200) + text(3)
        elif kind == 3 and rows:
            own = text(3) + (rng.choice(rows)[1] or "")[rng.randint(0, 40) :] + text(2)
        rows.append((rng.choice([i, i, i, i // 2]), own))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 10_000), (2, 3), (3, 0)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    """Also with many small chunks, blocks, hash ranges and transforms, and with all or some anchors taken apart."""
    rows = corpus(seed)
    if seed > 1:
        for name, value in (("CHUNK", 2000), ("BLOCK", 300), ("RANGE", 3000), ("TRANSFORM", 500)):
            monkeypatch.setattr(suffix_dedup, name, value)
    assert found(spark, rows, hot=hot) == brute(rows)


def test_other_length(spark):
    rows = corpus(4, 60)
    assert found(spark, rows, least=23) == brute(rows, 23)
    with pytest.raises(ValueError):
        suffix_dedup.deduplicate(docs(spark, rows), least=16)


def test_odd_rows(spark):
    same = "the same passage of more than fifty bytes that stands in many rows of this table"
    rows = [*[(i, t) for i, t, *_ in ODD], (None, same), (None, same), (40, same), (12, same + " \x00 end"), (12, same), (3, "word " * 20)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, ""), (2, None)]) == [(1, 0, [], b""), (2, 0, [], b"")]


def test_clashing_names_and_digests(spark):
    rows = corpus(5, 40)
    wide = docs(spark, rows).withColumns({c: F.lit("x") for c in ("chunk", "range", "blob", "kept", "bytes", "packed")})
    got = suffix_dedup.digests(suffix_dedup.deduplicate(wide)).collect()
    want = [(i, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_common_prefixes():
    rng = random.Random(6)
    for _ in range(300):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) + b"\xff"
        order, common = suffix_dedup.common_prefixes(np.frombuffer(text, dtype=np.uint8), 5)
        turned = [(text[i:] + text[:i])[:5] for i in order]
        assert turned == sorted((text[i:] + text[:i])[:5] for i in range(len(text)))
        assert common.tolist()[1:] == [next((k for k in range(min(5, len(text))) if a[k] != b[k]), min(5, len(text))) for a, b in zip(turned, turned[1:], strict=False)]
