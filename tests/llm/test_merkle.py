"""Merkle manifests against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from parcelog.llm import merkle

from .util import DOCUMENTS, ODD, docs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = []
    for v in (doc_id, source, lang, n_chars, text):
        v = None if v is None else str(v)
        parts.append("-" if v is None else f"{len(v.encode())}:{v}")
    return sha("".join(parts))


def tree(nodes):
    """The top and each node's siblings (left, right) up to it."""
    paths, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k : k + 8]
            for j in range(len(run)):
                for i in at[k + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha("".join(run)))
            members.append([i for group in at[k : k + 8] for i in group])
        nodes, at = above, members
    return nodes[0], paths


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        own[lang] = (mine, *tree([leaf(*r) for r in mine]))
    root, upper = tree([own[x][1] for x in langs]) if langs else (None, [])
    out = []
    for lang, up in zip(langs, upper, strict=True):
        mine, subroot, paths = own[lang]
        for r, path in zip(mine, paths, strict=True):
            whole = path + up
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            folded = leaf(r[0], low if hit and r[1] is not None else r[1], *r[2:])
            for left, right in whole:
                folded = sha(left + folded + right)
            out.append((r[0], leaf(*r), subroot, root, sha("".join(a + b for a, b in whole)), folded, folded == root))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, merkle.verified_manifest(df).collect()), key=repr)


def rows_of(sizes):
    """Documents of languages with so many rows each."""
    ids = iter(range(10_000))
    return [(next(ids) * 7 % 5003, f"Text {k} of {lang}", lang, None if k % 5 == 0 else "s", k) for lang, n in sizes.items() for k in range(n)]


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, "de": 1}, {"en": 700, None: 65, "": 64, "zh": 2, "é": 1}, {f"l{i:03}": 1 + i % 3 for i in range(70)}])
def test_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    got = found(spark.createDataFrame(rows, DOCUMENTS).repartition(5))
    assert got == brute(rows)
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0}
    assert all(g[6] == (g[0] not in changed) for g in got)


def test_odd_rows(spark):
    rows = [(*r[:2], *("en", "s", len(r[1] or ""))) for r in ODD] + [(None, None, None, None, None)] * 3
    assert found(docs(spark, rows)) == brute(rows)
    assert found(docs(spark, [])) == []


def test_clashing_names(spark):
    rows = rows_of({"en": 20, "de": 3})
    wide = spark.createDataFrame(rows, DOCUMENTS).withColumns({c: F.lit("x") for c in ("idx", "tree", "leaf", "digest", "n", "level", "other", "root")})
    assert found(wide) == brute(rows)
