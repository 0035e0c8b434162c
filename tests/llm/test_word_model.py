import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelog.llm import perplexity as p, queries, word_model
from tests.llm.test_perplexity import brute_counts
from tests.llm.util import ODD, docs


def fails(text):
    n, *_, repeated = brute_counts(text)
    return n < 10 or 100 * repeated > 20 * n


def brute_logs(rows, halves):
    """Interpolated modified Kneser-Ney over words of the other half, straight from its definition: (text, lang) to its logarithm and trigrams."""

    def grams(text):
        marked = ["<s>", "<s>", *text.encode().split(), "</s>"]
        return list(zip(marked, marked[1:], marked[2:], strict=False))

    def level(counts, below):
        c = Counter(counts.values())
        n1, n2, n3, n4 = (max(1, c[k]) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [0, *(min(k, max(0, k - (k + 1) * y * m / o)) for k, m, o in ((1, n2, n1), (2, n3, n2), (3, n4, n3)))]
        of = {}
        for g, n in counts.items():
            of.setdefault(g[:-1], []).append(n)
        weight = {g: (sum(own), sum(d[min(n, 3)] for n in own) / sum(own)) for g, own in of.items()}

        def prob(g):
            if g[:-1] not in weight:
                return below(g[1:])
            total, left = weight[g[:-1]]
            return (counts[g] - d[min(counts[g], 3)]) / total + left * below(g[1:])

        return prob

    logs = {}
    for lang in {r[2] for r in rows}:
        texts = {t for _, t, own in rows if own == lang and t is not None and not fails(t)}
        for half in (0, 1):
            tri = Counter(g for t in texts if halves[lang, t] != half for g in grams(t))
            if not tri:
                continue
            bi = Counter(g[1:] for g in tri)
            uni = Counter(g[1:] for g in bi)
            prob = level(tri, level(bi, level(uni, lambda _, n=len(uni) + 1: 1 / n)))
            for t in texts:
                if halves[lang, t] == half:
                    logs[t, lang] = sum(math.log(prob(g)) for g in grams(t)), len(grams(t))
    return logs


def corpus():
    rng = np.random.default_rng(11)
    words = [w for w in ("the", "of", "und", "straße", "été", "|", "мир", "x1") for _ in range(6)] + [f"w{i}" for i in range(60)]
    rows = [(10 + i, ("\n" if i % 7 == 0 else " ").join(rng.choice(words, rng.integers(5, 120))), ("en", "de", None)[i % 3]) for i in range(120)]
    rows += [(900 + i, " ".join(f"junk{rng.integers(10**9)}" for _ in range(30)), "en") for i in range(4)]
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(40)]
    return rows + [(r[0], r[1], "en") for r in ODD]


@pytest.mark.parametrize("cut", [{}, {"part_words": 300, "rounds": 3, "shown": 1}, {"part_words": 4000, "rounds": 2, "shown": 1}])
def test_perplexity_of_words_equals_brute_force(spark, cut):
    rows = corpus()
    halves = {}
    for _, t, lang in rows:
        c = word_model.codes(lang or "", [b" ", b" ", *(t or "").encode().split(), b"\n"])
        halves[lang or "", t] = int(word_model.half(word_model._mix(word_model._mix(c[:-2], c[1:-1]), c[2:]), np.array([0]))[0])
    logs = brute_logs([(d, t, lang or "") for d, t, lang in rows], halves)
    assert {(lang, halves[lang, t]) for t, lang in logs} == {(lang, half) for lang in ("en", "de", "") for half in (0, 1)}
    want = sorted(((d or 0), t or "", math.exp(-logs[t, lang or ""][0] / logs[t, lang or ""][1]) if (t, lang or "") in logs else None) for d, t, lang in rows)
    texts = {}
    got = p.rules(docs(spark, rows), words=True, **cut).collect()
    for r in got:
        texts.setdefault(r.doc_id or 0, []).append(r)
    assert len(got) == len(rows)
    for d, t, perplexity in want:
        r = texts[d].pop()
        assert r.base_failed == fails(t) == (r.perplexity is None)
        assert r.perplexity is None or math.isclose(r.perplexity, perplexity, rel_tol=1e-5)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[900 + i] for i in range(4))
    assert np.mean([kept[d] for d, t, _ in rows[:120] if not fails(t)]) > 0.9


def test_query_tells_words_apart_where_symbols_are_alike(spark, tmp_path):
    """Two texts of one shape in symbols: capitals, digits and letters of a class are one symbol each, words are not."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["A1", "B2", "C3", "D4", "F5", "G6", "H7"], 60)), "en") for i in range(60)]
    odd = " ".join(f"{a}{b}" for a, b in zip(rng.choice(list("BCDFGHJKLMNPQRSTVWXZ"), 60), rng.integers(0, 10, 60), strict=True))
    docs(spark, [*rows, (99, odd, "en")]).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.perplexity for r in queries.op3_quality_rules(spark, str(tmp_path)).collect() if not r.base_failed}
    assert found[99] > 3 * max(v for d, v in found.items() if d != 99)


def test_tables_without_texts(spark):
    assert p.rules(docs(spark, []), words=True).count() == 0
    assert [(r.kept, r.n_words) for r in p.rules(docs(spark, [(1, "", "en"), (2, None, None)]), words=True).collect()] == [(False, 0)] * 2


def test_repeated_words_of_many_texts():
    rng = np.random.default_rng(6)
    texts = [[b"%d" % w for w in rng.integers(0, 1 + i % 4, rng.integers(0, 40))] for i in range(200)]
    code = word_model.codes("en", [w for t in texts for w in t])
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = np.bincount(text, word_model.repeated(code, text, 5), len(texts))
    assert got.tolist() == [p.repeated_words(t) for t in texts]


def test_blocks_of_numbers_keep_texts_and_half():
    """Words with and without a rank come back from a block; a text met before isn't written again."""
    texts = ["one two three four", "two rare words two", "one two three four"]
    ranked = word_model.codes("en", [b"two", b"one"])
    coder = word_model.Coder(word_model.Numbers({"en": (ranked, np.array([9, 5]))}), lambda n, repeat: n > 0, 5)
    n, repeat, block = coder.block("en", np.array([2, 4, 2]), pa.array(texts))
    assert n.tolist() == [4, 4, 4] and not repeat.any()
    others, number, keys, length = word_model.unpacked(pa.py_buffer(block), np.uint64, np.int32, np.int64, np.int32)
    code = np.concatenate([coder.ranks.codes("en"), others])
    assert code[number].tolist() == word_model.codes("en", " ".join(texts[:2]).encode().split()).tolist()
    assert (keys & -2).tolist() == [2, 4] and length.tolist() == [4, 4] and len(others) == 4
    assert coder.block("en", np.array([2]), pa.array(texts[:1]))[2] is None
