import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parcelog.llm import perplexity as p
from tests.llm.util import DOCUMENTS, ODD, docs


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\x85é#|", max_size=60))
def test_base_counts(text):
    assert p.base_counts(text) == brute_counts(text)


def test_repeated_words_with_many_different_words():
    words = [b"%d" % i for i in range(9000)] + [b"%d" % i for i in range(100, 140)]
    assert p.repeated_words(words) == 80


def brute_model(texts):
    """Interpolated modified Kneser-Ney, straight from its definition."""
    tri = Counter()
    for t in texts:
        tri.update(p.trigrams(t).tolist())
    n = p.SYMBOLS
    tri = Counter({(g // n // n, g // n % n, g % n): c for g, c in tri.items()})
    bi, uni = Counter(), Counter()
    for _, y, z in tri:
        bi[y, z] += 1
    for _, z in bi:
        uni[(z,)] += 1

    def discount(counts):
        c = Counter(counts.values())
        n1, n2, n3, n4 = (max(1, c[k]) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        return [0, *(min(k, max(0, k - (k + 1) * y * m / o)) for k, m, o in ((1, n2, n1), (2, n3, n2), (3, n4, n3)))]

    def level(counts, below):
        d = discount(counts)
        of = {}
        for g, c in counts.items():
            of.setdefault(g[:-1], []).append(c)

        def prob(g):
            own = of.get(g[:-1])
            if not own:
                return below(g[1:])
            total = sum(own)
            c = counts.get(g, 0)
            return (c - d[min(c, 3)]) / total + sum(d[min(c, 3)] for c in own) / total * below(g[1:])

        return prob

    return level(tri, level(bi, level(uni, lambda g: 1 / n)))


def test_model_equals_definition():
    texts = ["the cat sat on the mat.", "a cat, 12 hats!", "ab" * 30, ""]
    prob = brute_model(texts)
    grams = np.concatenate([p.trigrams(t) for t in texts])
    gram, n = np.unique(grams, return_counts=True)
    table = p.dense(*p.estimate(gram, n))
    rng = np.random.default_rng(0)
    for g in [*gram[:60].tolist(), *rng.integers(0, p.SYMBOLS**3, 300).tolist()]:
        assert math.isclose(math.exp(table[g]), prob((g // 96 // 96, g // 96 % 96, g % 96)), rel_tol=1e-4)
    assert np.allclose(np.exp(table.reshape(-1, p.SYMBOLS)).sum(axis=1), 1, atol=1e-4)


def test_rules(spark):
    rng = np.random.default_rng(1)
    syllables = ["ka", "lo", "mi", "ten", "sur", "ve"]
    prose = lambda: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(80)) + "."
    good = [(i, prose()) for i in range(200)]
    junk = [(1000 + i, " ".join(f"%{rng.integers(10**9)}|{chr(65 + k % 26)}Q#" for k in range(60))) for i in range(8)]
    table = spark.createDataFrame(docs(spark, good + junk + ODD).rdd.map(tuple).collect() + [(5000, "text in no language at all, " * 3, None, None, None)], DOCUMENTS).withColumn("size", F.lit(1)).withColumn("n_words", F.lit("x"))
    rows = p.rules(table).collect()
    assert len(rows) == 209 + len(ODD)
    texts = {}
    for r in rows:
        if r.doc_id is not None and r.doc_id >= 10:
            texts[r.doc_id] = r
    assert np.mean([texts[i].kept for i, _ in good if i >= 10]) >= 0.97 and not any(texts[i].kept for i, _ in junk)
    for i, t in good[10:] + junk:
        r = texts[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    assert p.rules(docs(spark, [])).count() == 0


def test_bands_are_medians(spark):
    rng = np.random.default_rng(2)
    rows = [(lang, int(s), float(x)) for lang in ("a", "b") for s in (3, 4) for x in rng.normal(2 + s, 0.5, 301)]
    found = {(r.lang, r.size): r for r in p.bands(spark.createDataFrame(rows, "lang string, size int, log_perplexity double")).collect()}
    for key in ((a, s) for a in ("a", "b") for s in (3, 4)):
        x = np.array([v for lang, s, v in rows if (lang, s) == key])
        median = np.median(x)
        half = p.WIDTH * np.median(np.abs(x - median))
        assert math.isclose(found[key].low, median - half, abs_tol=0.08) and math.isclose(found[key].high, median + half, abs_tol=0.08)
    assert found[None, None].docs == 1204 and found["a", None].docs == 602


def test_copies_count_once(spark):
    rng = np.random.default_rng(4)
    syllables = ["ka", "lo", "mi", "ten", "sur", "ve"]
    prose = lambda: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(80)) + "."
    good = [(i, prose()) for i in range(150)]
    junk = " ".join(f"%{rng.integers(10**9)}|{chr(65 + k % 26)}Q#" for k in range(30))
    kept = {}
    for n in (1, 400):
        rows = p.rules(docs(spark, good + [(1000 + i, junk) for i in range(n)])).collect()
        assert len(rows) == 150 + n and not any(r.kept for r in rows if r.doc_id >= 1000)
        kept[n] = {r.doc_id: (r.kept, r.perplexity) for r in rows if r.doc_id < 1000}
    assert kept[1] == kept[400] and np.mean([k for k, _ in kept[1].values()]) >= 0.97


def test_languages_without_a_model(spark):
    prose = "some words of plain text that go on for a while and then end here"
    rows = p.rules(docs(spark, [(1, prose, "en"), (2, "", "xx"), (3, " \n", "xx"), (4, None, "yy"), (5, "few words", "zz")])).collect()
    assert {r.doc_id: (r.kept, r.base_failed) for r in rows} == {1: (True, False), **{i: (False, True) for i in (2, 3, 4, 5)}}
    assert [(r.kept, r.n_words) for r in p.rules(docs(spark, [(1, "", "en"), (2, None, None)])).collect()] == [(False, 0)] * 2


def brute_kept(rows, width=p.WIDTH, least=p.LEAST_DEVIATION, prior=p.PRIOR_DOCS):
    """Verdicts straight from the definitions, one text at a time."""

    def fails(text):
        n, *_, repeated = brute_counts(text)
        return n < 10 or 100 * repeated > 20 * n

    log, models = {}, {lang: brute_model(sorted({t for _, t, own in rows if own == lang and t is not None and not fails(t)})) for lang in {r[2] for r in rows if r[1] and not fails(r[1])}}
    for _, text, lang in rows:
        grams = p.trigrams(text or "").tolist()
        if lang in models and grams and not fails(text):
            log[text, lang] = -sum(math.log(models[lang]((g // p.SYMBOLS**2, g // p.SYMBOLS % p.SYMBOLS, g % p.SYMBOLS))) for g in grams) / len(grams), int(math.log2(len(grams)))

    def band(steps):
        steps = sorted(steps)
        median = steps[(len(steps) - 1) // 2]
        off = sorted(abs(x - median) for x in steps)[(len(steps) - 1) // 2]
        half = max(off * p.STEP, least) * width
        return median * p.STEP - half, median * p.STEP + half, len(steps)

    step = lambda x: math.floor(x / p.STEP + 0.5)
    blend = lambda own, general: tuple((own[2] * o + prior * g) / (own[2] + prior) for o, g in zip(own[:2], general[:2]))
    of_all = band([step(x) for x, _ in log.values()])
    kept = {}
    for d, text, lang in rows:
        if fails(text) or (text, lang) not in log:
            kept[d] = False
            continue
        own = [(x, s) for (_, other), (x, s) in log.items() if other == lang]
        x, size = log[text, lang]
        general = blend(band([step(v) for v, _ in own]), of_all)
        low, high = blend(band([step(v) for v, s in own if s == size]), general)
        kept[d] = low <= x <= high
    return kept


def test_kept_equals_brute_force_in_other_scripts(spark):
    rng = np.random.default_rng(8)
    letters = {"en": "etaoinshrdlu", "ru": "оеаинтсрвлкмдпуяыьгзбчй", "zh": "的一是不了人我在有他这为之大来以个中上们", "ar": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"}
    rows, i = [], 0
    for lang, own in letters.items():
        weight = 1 / np.arange(2, len(own) + 2)
        words = ["".join(rng.choice(list(own), rng.integers(1, 8), p=weight / weight.sum())) for _ in range(60)]
        for _ in range(45):
            rows.append((i := i + 1, " ".join(rng.choice(words, rng.integers(12, 160))) + ".", lang))
        for _ in range(5):
            rows.append((i := i + 1, "".join(rng.choice(list("#$%&*|<>{}[]~^0123456789QXZ "), 400)), lang))
    rows += [(i + 1, rows[3][1], "en"), (i + 2, rows[3][1], "en"), (i + 3, "", "ru"), (i + 4, None, "zh"), (i + 5, "word " * 40, "en")]
    got = {r.doc_id: r.kept for r in p.rules(docs(spark, rows)).collect()}
    assert got == brute_kept(rows)
    for lang in letters:
        good = [d for d, t, own in rows if own == lang and t and t.endswith(".")]
        junk = [d for d, t, own in rows if own == lang and t and "#" in t and "~" in t]
        assert np.mean([got[d] for d in good]) >= 0.9 and not any(got[d] for d in junk), lang


def test_limits_are_arguments(spark):
    rng = np.random.default_rng(3)
    rows = docs(spark, [(i, " ".join(rng.choice(["ka", "lomi", "ten", "sur", "velo", "ra"], 60))) for i in range(80)])
    assert p.rules(rows, width=0.0).filter("kept").count() < p.rules(rows, width=50.0).filter("kept").count() == 80 - p.rules(rows).filter("base_failed").count()
