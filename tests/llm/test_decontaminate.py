import random
import time

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parcelog.llm import decontaminate as d
from tests.llm.util import ODD, docs


def brute(item, place):
    """Fewest edits of ``item`` against any part of ``place``."""
    row = [0] * (len(place) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(place):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=14), st.text("abc", max_size=30), st.integers(0, 6))
def test_align(item, place, most):
    got, best = d.align(item.encode(), place.encode(), most), brute(item, place)
    assert (got is None) == (best > most)
    if got:
        edits, a, z = got
        assert edits == best and brute(item, place[a:z]) == best


def word(rng):
    return "".join(rng.choice(list("abcdefghij"), rng.integers(2, 9)))


def planted(seed=7):
    rng = np.random.default_rng(seed)
    items = [(i, " ".join(word(rng) for _ in range(n))) for i, n in enumerate([3, 9, 20, 40, 45, 120, 200])] + [(50, None), (51, ""), (52, "?!")]
    rows = []
    for i in range(150):
        text = [word(rng) for _ in range(rng.integers(0, 120))]
        if i % 3 == 0:
            leak = list(items[rng.integers(7)][1])
            for _ in range(rng.integers(0, 1 + len(leak) // 14)):
                k = rng.integers(len(leak))
                leak[k : k + rng.integers(0, 2)] = rng.choice(list("abcxyz")) * int(rng.integers(0, 2))
            text.insert(len(text) // 2, "".join(leak).upper() if i % 2 else "".join(leak).replace(" ", ",  "))
        rows.append((i, " ".join(text)))
    return items, rows


def test_search_equals_brute_force():
    items, rows = planted()
    short = [(k, t) for k, t in items[:5] if t]
    block = d.Block([(k, d.normalise(t)) for k, t in short], 0.08)
    for _, text in rows:
        place = d.normalise(text)
        got = {k for k, *_ in block.search(place)}
        for n, (k, t) in enumerate(short):
            item = d.normalise(t)
            if len(item) < d.WHOLE_WORDS_BELOW:
                assert (n in got) == (f" {item.decode()} " in f" {place.decode()} ")
            elif len(item) <= 360:
                assert (n in got) == (brute(item, place) <= int(0.08 * len(item)))


def test_leaks_and_drop(spark):
    items, rows = planted(8)
    rows = rows + ODD + [(None, items[3][1]), (900, "x " + items[6][1][300:800])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.leaks(docs(spark, rows), table).collect()}
    blocks = {(r.doc_id, r.item_id) for r in d.leaks(docs(spark, rows), table, block_bytes=200).collect()}
    assert got == blocks and {(None, 3), (900, 6)} <= got and len(got) > 30
    kept = [r.doc_id for r in d.drop_leaks(docs(spark, rows), table).collect()]
    block = d.Block([(k, d.normalise(t)) for k, t in items], d.BUDGET)
    assert sorted(kept, key=str) == sorted((i for i, t in rows if not list(block.search(d.normalise(t)))), key=str)
    assert d.leaks(docs(spark, rows), table.limit(0)).count() == 0 and d.leaks(docs(spark, []), table).count() == 0


def test_windows_of_items_of_middle_length():
    rng = np.random.default_rng(3)
    for n in (241, 300, 350, 360, 361, 420, 500):
        item = " ".join(word(rng) for _ in range(200)).encode()[:n].rstrip().ljust(n, b"x")
        block = d.Block([(1, item)], d.BUDGET)
        for part in (item, item[: d.WINDOW], item[-d.WINDOW :]):
            assert [k for k, *_ in block.search(b"some words " + part + b" more words")] == [0]
        assert not list(block.search(b"some words " + item[: d.WINDOW // 2] + b" more words"))


def test_short_items_with_edits():
    rng = np.random.default_rng(5)
    for n in range(16, 40):
        item = " ".join(word(rng) for _ in range(20)).encode()[:n].rstrip().ljust(n, b"x")
        most = int(d.BUDGET * n)
        block = d.Block([(1, item)], d.BUDGET)
        for k in range(n):
            other = item[:k] + b"0" + item[k + 1 :]
            assert [e for _, e, *_ in block.search(b"words " + other + b" words")] == [1]
        spread = bytearray(item)
        spread[:: n // (most + 1)] = b"0" * len(spread[:: n // (most + 1)])
        assert not list(block.search(bytes(spread)))


def fewest_edits(item, place):
    """``brute`` a row at a time: insertions by a running minimum of value less column."""
    b, row = np.frombuffer(place, np.uint8), np.zeros(len(place) + 1, np.int64)
    steps = np.arange(len(row))
    for a in item:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (b != a))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def edited(rng, text, edits):
    out = list(text)
    for k in sorted(rng.choice(len(out), edits, replace=False).tolist(), reverse=True):
        kind = rng.integers(3)
        out[k : k + (kind > 0)] = [] if kind == 1 else ["z"]
    return "".join(out)


def test_items_of_all_lengths_equal_brute_force():
    """Whole items within their own budgets at every length; recall and precision are 1."""
    rng = np.random.default_rng(17)
    items = []
    for n in (5, 5, 9, 13, 14, 15, 16, 30, 30, 100, 240, 241, 400, 3000):
        items.append(" ".join(word(rng) for _ in range(n)).encode()[:n].rstrip().ljust(n, b"q"))
    rows = [" ".join(word(rng) for _ in range(40)).encode() for _ in range(6)]
    for item in items:
        most = int(d.BUDGET * len(item))
        for edits in {0, most, most + 1, 2 * most}:
            rows.append(f"{word(rng)} {edited(rng, item.decode(), min(edits, len(item)))} {word(rng)}".encode())
    whole, both = d.Block(list(enumerate(items)), d.BUDGET, window=None), d.Block(list(enumerate(items)), d.BUDGET)
    hits = 0
    for text in rows:
        text = d.normalise(text.decode())
        expected, parts = set(), set()
        for k, item in enumerate(items):
            if len(item) < d.WHOLE_WORDS_BELOW:
                found = f" {item.decode()} " in f" {text.decode()} "
            else:
                found = fewest_edits(item, text) <= int(d.BUDGET * len(item))
            expected |= {k} if found else set()
            windows = [item[a : a + 240] for a in sorted({*range(0, len(item) - 240, 120), len(item) - 240})] if len(item) > 240 else []
            parts |= {k} if found or any(fewest_edits(w, text) <= int(d.BUDGET * 240) for w in windows) else set()
        assert {k for k, *_ in whole.search(text)} == expected
        got = list(both.search(text))
        assert {k for k, *_ in got} == parts and {k for k, *_, all_ in got if all_} == expected
        for k, edits, a, z, all_ in got:
            if all_ and len(items[k]) >= d.WHOLE_WORDS_BELOW:
                assert edits == fewest_edits(items[k], text) == fewest_edits(items[k], text[a:z])
        hits += len(expected)
    assert hits >= 28  # each item at none and at its most edits


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=150), st.text("abc", max_size=200)), min_size=1, max_size=12))
def test_many_at_once_equal_one_by_one(pairs):
    edits, ends = d.fewest_of_many([p.encode() for p, _ in pairs], [t.encode() for _, t in pairs])
    assert list(zip(edits.tolist(), ends.tolist())) == [d.fewest(p.encode(), t.encode()) for p, t in pairs]


def test_budgets_that_need_shorter_grams():
    rng = np.random.default_rng(19)
    for budget in (0.12, 0.2, 0.3):
        items = [" ".join(word(rng) for _ in range(30)).encode()[:n].rstrip().ljust(n, b"q") for n in (20, 60, 150)]
        block = d.Block(list(enumerate(items)), budget, window=None)
        for item in items:
            for edits in (0, int(budget * len(item)), int(budget * len(item)) + 3):
                text = d.normalise(f"{word(rng)} {edited(rng, item.decode(), edits)} {word(rng)}")
                assert {k for k, *_ in block.search(text)} == {k for k, x in enumerate(items) if fewest_edits(x, text) <= int(budget * len(x))}


def test_items_with_a_common_prompt():
    """Thousands of items begin alike and a text repeats that beginning: bounded memory, no quadratic work."""
    rng = np.random.default_rng(23)
    prompt = (" ".join(word(rng) for _ in range(20)).encode()[:79].rstrip() + b" ").ljust(80, b"q")
    items = [prompt + " ".join(word(rng) for _ in range(9)).encode()[:40].rstrip().ljust(40, b"q") for _ in range(3000)]
    block = d.Block(list(enumerate(items)), d.BUDGET)
    parts = [prompt + " ".join(word(rng) for _ in range(9)).encode()[:40] for _ in range(107)]
    parts[40] = items[77][:60] + b"zz" + items[77][62:]
    text = b" ".join(parts)
    assert len(text) > 12_800
    began = time.time()
    got = list(block.search(text))
    assert time.time() - began < 20  # about 3 s on a free machine
    assert (77, 2) in [(k, e) for k, e, *_ in got]
    for k in rng.choice(3000, 25, replace=False).tolist():
        assert (k in {g for g, *_ in got}) == (fewest_edits(items[k], text) <= int(d.BUDGET * len(items[k])))


def test_clashing_names_and_many_blocks(spark):
    items, rows = planted(9)
    table = spark.createDataFrame(items, "item_id long, text string")
    own = docs(spark, rows).withColumn("leaks_", F.lit("mine")).withColumn("item_id", F.lit(3))
    kept = d.drop_leaks(own, table)
    assert kept.columns == own.columns and {r.leaks_ for r in kept.collect()} == {"mine"}
    few = d.drop_leaks(own, table, block_bytes=100)  # more blocks than a pass takes
    assert {r.doc_id for r in few.collect()} == {r.doc_id for r in kept.collect()}


def test_hits_do_not_depend_on_other_items():
    """One item with equally good places, alone and beside a thousand like items."""
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n)).encode()
    for _ in range(4):
        item = text(70)
        spoilt = [item[:k] + b"z" + item[k + 1 :] for k in (20, 33, 47)]
        doc = text(30) + spoilt[0] + text(400) + spoilt[1] + text(200) + spoilt[2] + text(20)
        alike = [(k, bytes(item[:40]) + text(30)) for k in range(1000)]
        alone = list(d.Block([(-1, item)], d.BUDGET).search(doc))
        among = [h for h in d.Block([(-1, item), *alike], d.BUDGET).search(doc) if h[0] == 0]
        assert alone == among and alone[0][1] == 1 and alone[0][2] == 30


def test_whole_words_are_a_parameter():
    inside = b"xx" + b"abcdefghijkl" + b"myy other words"
    assert [h[0] for h in d.Block([(7, b"abcdefghijkl"), (8, b"other")], d.BUDGET).search(inside)] == [1]
    found = {h[0]: h[1:4] for h in d.Block([(7, b"abcdefghijkl"), (8, b"othe"), (9, b"words")], d.BUDGET, whole_words_below=4).search(inside)}
    assert found == {0: (0, 2, 14), 1: (0, 18, 22), 2: (0, 24, 29)}
    assert not list(d.Block([(7, b"abcdefghijklm")], d.BUDGET, whole_words_below=14).search(inside))
