import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelog.llm import edit_counts as e, licenses as li
from parcelog.llm.tokens import encoder
from parcelog.storage import scratch_path
from tests.llm.util import ODD, docs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


EDIT = st.tuples(st.integers(0, 10**6), st.integers(0, 60), st.text(alphabet="ab '.\n\té́", max_size=12))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(["word", " ", "  ", "\n", "don't", "!!", "é", "́", "x" * 30, "\x85", "."]), max_size=300), st.lists(EDIT, max_size=8))
def test_edits_equal_counting_anew(parts, edits):
    text = "".join(parts)
    e.LEAF = 40
    tree = e.EditTree(text, encoder(PATH).encode)
    assert tree.n_tokens == count(text)
    for at, size, new in edits:
        start = at % (len(text) + 1)
        end = min(len(text), start + size)
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
        assert tree.n_tokens == count(text) and "".join(tree.leaves) == text
    e.LEAF = 512


def test_only_the_region_is_encoded():
    text = "some words of prose, " * 5000
    tree = e.EditTree(text, encoder(PATH).encode)
    tree.edit(50_000, 50_010, "other")
    assert tree.encoded < 3000 and tree.n_tokens == count(text[:50_000] + "other" + text[50_010:])


def test_leaves_split_and_merge():
    """A growing text is never encoded as a whole, and leaves stay near LEAF both ways."""
    tree, text = e.EditTree("", encoder(PATH).encode), ""
    r = random.Random(3)
    for _ in range(200):
        at = r.randint(0, len(text))
        new = " ".join(r.choice(["some", "words", "of", "prose"]) for _ in range(24))[:120]
        tree.edit(at, at, new)
        text = text[:at] + new + text[at:]
    assert "".join(tree.leaves) == text and tree.n_tokens == count(text)
    assert tree.encoded <= 200 * 1500 and max(map(len, tree.leaves)) < 3 * e.LEAF
    grown = len(tree.leaves)
    while len(text) > 2000:
        at = r.randint(0, len(text) - 200)
        tree.edit(at, at + 200, "")
        text = text[:at] + text[at + 200 :]
    assert "".join(tree.leaves) == text and tree.n_tokens == count(text) and len(tree.leaves) < grown / 4


def test_stale_states_are_noticed(spark):
    schema = f"doc_id long, text string, edits {e.EDITS}, leaf_lengths array<int>, leaf_counts array<int>"
    text = "hello world again"
    states = [([5], [1]), ([5, 12], [1]), ([4, 13], [1, 2]), ([17, 0], [3, 0]), ([None, 12], [1, 2]), (None, [3]), ([17], [-3])]
    rows = [(i, text, [], *s) for i, s in enumerate(states)]
    assert [x.counts.n_tokens for x in e.with_counts(spark.createDataFrame(rows, schema), PATH).collect()] == [count(text)] * len(rows)


def test_masked_counts(spark):
    r = random.Random(1)
    bits = ["plain", "a.b@mail.example.com", "10.20.30.40", "1234567890", "é", "\n", "x@y", "12"]
    rows = [(i, " ".join(r.choice(bits) for _ in range(r.randrange(300)))) for i in range(60)] + ODD
    table = docs(spark, rows).withColumn("counts", F.lit(1))
    edited = e.with_counts(e.mask_edits(table.drop("counts")), PATH).collect()
    assert len(edited) == len(rows)
    for row in edited:
        text, c = row.text or "", row.counts
        assert c.n_tokens_before == count(text)
        for x in sorted(row.edits, key=lambda x: -x.start):
            text = text[: x.start] + x.text + text[x.end :]
        assert c.n_tokens == count(text) and c.n_edits == len(row.edits) and sum(c.leaf_lengths) == len(text) and sum(c.leaf_counts) == c.n_tokens
        assert "@mail" not in text and "1234567890" not in text
    again = spark.createDataFrame([(r.doc_id, r.text, [(0, 0, "new ")], [len(r.text or "")] if r.text else [], [7] if r.text else []) for r in edited], f"doc_id long, text string, edits {e.EDITS}, leaf_lengths array<int>, leaf_counts array<int>")
    assert all(r.counts.n_tokens_before == (7 if r.text else 0) for r in e.with_counts(again, PATH).collect())  # the state is taken, not counted anew
    full = e.masked_counts(table, PATH).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in full) == Counter((r.doc_id, r.counts.n_tokens) for r in edited)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path := scratch_path(spark, "edited"))
    stored = e.masked_counts(spark.read.parquet(path), PATH).collect()  # plans over files differ from those over local rows
    assert Counter(map(tuple, stored)) == Counter(map(tuple, full))
    assert e.masked_counts(docs(spark, []), PATH).count() == 0


def test_overlapping_edits_are_refused(spark):
    with pytest.raises(Exception, match="overlap"):
        e.with_counts(docs(spark, [(1, "abcdef")]).withColumn("edits", F.expr("array(struct(0 as start, 3 as end, 'x' as text), struct(2 as start, 4 as end, 'y' as text))")), PATH).collect()


def brute_scan(text, templates, threshold):
    """All passages against all templates, without pruning."""
    lines = (text or "").split("\n")
    passages, block, blocks = [], [], []
    for line in [*lines, ""]:
        if li.words_of(line):
            passages.append(line)
            parts = li._SENTENCE.split(line)
            passages += parts if len(parts) > 1 else []
            block.append(line)
        elif block:
            blocks.append(block)
            block = []
    passages += [" ".join(b) for b in blocks if len(b) > 1]
    passages += [" ".join(x for b in blocks for x in b)] if len(blocks) > 1 else []
    found = {}
    for p in passages:
        own = li.bigrams(li.words_of(p))
        scores = {}
        for name, t in templates:
            other = li.bigrams(li.words_of(t))
            if own and other:
                scores[name] = max(scores.get(name, 0), 2 * (own & other).total() / (own.total() + other.total()))
        most = max(scores.values(), default=0)
        for name, v in scores.items():
            if v == most and v >= threshold:
                found.setdefault(name, []).append(v)
    return sorted((k, max(v), len(v)) for k, v in found.items())


def licence_texts():
    r = random.Random(5)
    texts = []
    for _ in range(150):
        words = [r.choice(["plain", "the", "license", "under", "of", "software", "prose"]) for _ in range(r.randrange(40))]
        _, t = r.choice(li.TEMPLATES)
        own = t.split()
        for _ in range(r.randrange(0, 1 + len(own) // 6)):
            own[r.randrange(len(own))] = r.choice(["changed", "the"])
        t = " ".join(own)
        if r.random() < 0.5:
            t = t.replace(" ", "\n", r.randrange(4)).upper()
        texts.append(r.choice(["{} {}", "{}\n{}", "{}\n\n{}\n\nmore", "{}. {}"]).format(" ".join(words), t))
    return texts


def test_scan_equals_brute_force():
    known = li.Templates(li.TEMPLATES, 0.8)
    texts = licence_texts()
    assert sum(bool(known.scan(t)) for t in texts) > 60
    for t in [*texts, *(t for _, t in ODD)]:
        assert known.scan(t) == brute_scan(t, li.TEMPLATES, 0.8)


def test_licenses(spark):
    rows = list(enumerate(licence_texts()[:40])) + ODD + [(None, "Released under the MIT License.")]
    got = Counter((r.doc_id, r.license, round(r.dice, 9), r.n_passages) for r in li.licenses(docs(spark, rows).withColumn("license", F.lit(1))).collect())
    known = li.Templates(li.TEMPLATES, 0.8)
    assert got == Counter((d, a, round(b, 9), c) for d, t in rows for a, b, c in known.scan(t))
    assert li.licenses(docs(spark, [])).count() == 0


def test_edits_that_are_null_overlap_or_clash(spark):
    kind = "doc_id long, text string, counts string, edits array<struct<start:int,end:int,text:string>>"
    rows = [
        (1, "some words here", "mine", [None, (None, 3, "x"), (0, None, "x"), (0, 4, None)]),
        (2, "abcdef ghi", "mine", [(0, 3, "x"), (2, 4, "y"), (5, 99, "z"), (-1, 2, "q"), (7, 10, "W")]),
        (3, "a b", "mine", [(1, 1, " first"), (1, 1, " second"), (1, 2, "_")]),
        (4, None, None, None),
        (5, None, None, [(0, 0, "new text")]),
    ]
    table = spark.createDataFrame(rows, kind)
    got = {r.doc_id: r for r in e.with_counts(table, PATH, refuse="skip", name="own").collect()}
    texts = {1: " words here", 2: "xdef W", 3: "a first second_b", 4: "", 5: "new text"}
    assert {k: r.own.n_tokens for k, r in got.items()} == {k: count(t) for k, t in texts.items()}
    assert [(r.own.n_edits, r.own.n_refused) for _, r in sorted(got.items())] == [(1, 0), (2, 3), (3, 0), (0, 0), (1, 0)]
    assert got[1].counts == "mine"
    assert "n_tokens" in e.with_counts(table, PATH, refuse="skip").schema["counts"].dataType.fieldNames()  # gives way to the result
    with pytest.raises(Exception, match="beyond"):
        e.with_counts(table.filter("doc_id = 2").withColumn("edits", F.slice("edits", 3, 1)), PATH).collect()


def test_mail_masks_in_long_texts(spark):
    text = "a@b.example.org," * 20_000 + "x" * 100_000 + " 12345678"
    [row] = e.mask_edits(docs(spark, [(1, text)])).select("edits").collect()
    assert len(row.edits) == 20_001 and text[row.edits[-1].start :] == "12345678"


def brute_windows(text, templates, threshold):
    """Every window that begins with a bigram of its template, without pruning: the coefficients of each licence's passages."""
    words, passages = li.words_of(text or ""), []
    for licence in {name for name, _ in templates}:
        hits = []
        for other in (li.bigrams(li.words_of(t)) for name, t in templates if name == licence):
            size = other.total()
            for a in range(len(words) - 1):
                own = li.bigrams(words[a : a + size + 1])
                common = (own & other).total()
                if (words[a], words[a + 1]) in other and 2 * common / (own.total() + size) >= threshold:
                    hits.append((a, min(a + size + 1, len(words)), common, 2 * common / (own.total() + size)))
        while hits:  # one passage: all windows that hang together
            group, grown = [hits.pop()], True
            while grown:
                near = [h for h in hits if any(h[0] < g[1] and g[0] < h[1] for g in group)]
                grown = bool(near)
                group += near
                hits = [h for h in hits if h not in near]
            passages.append((max(g[2] for g in group), max(g[3] for g in group), min(g[0] for g in group), max(g[1] for g in group), licence))
    taken, found = [0] * len(words), {}
    for common, dice, a, z, licence in sorted(passages, reverse=True):
        if max(taken[a:z]) <= common:
            taken[a:z] = [common] * (z - a)
            found.setdefault(licence, []).append(dice)
    return found


def wrapped_texts():
    r = random.Random(9)
    texts = []
    for k in range(60):
        prose = lambda: " ".join(r.choice(["plain", "the", "license", "under", "of", "software", "prose", "and"]) for _ in range(r.randrange(5, 40)))
        own = r.choice(li.TEMPLATES + li.MORE_TEMPLATES)[1].split()
        for _ in range(r.randrange(0, 1 + len(own) // 10)):
            own[r.randrange(len(own))] = "changed"
        lines = [" ".join(own[a : a + 9]) for a in range(0, len(own), 9)]
        texts.append(f"{prose()} " + ("\n" if k % 2 else "\n#\n# ").join(lines) + f" {prose()}")
    return texts


def test_windows_equal_brute_force():
    every = li.TEMPLATES + li.MORE_TEMPLATES
    windows, hits = li.Windows(every, 0.8), 0
    for text in [*wrapped_texts(), *licence_texts()[:40], "", "one", "MIT License."]:
        got = windows.find(li.words_of(text)) if text else {}
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute_windows(text, every, 0.8).items()}, text
        hits += bool(got)
    assert hits > 60


def test_wrapped_notices_are_found(spark):
    gpl = li.TEMPLATES[7][1].split()
    header = "".join(f"# {' '.join(gpl[a : a + 10])}\n" + "#\n" * (a == 40) for a in range(0, len(gpl), 10))
    rows = [(1, header + "\nimport os\nprint(1)\n"), (2, "This thing is licensed under the Apache License,\nVersion 2.0. More is said elsewhere."), (3, "nothing here at all"), (4, None)]
    got = {(r.doc_id, r.license) for r in li.licenses(docs(spark, rows), li.TEMPLATES + li.MORE_TEMPLATES, windows=True).collect()}
    assert got == {(1, "GPL-3.0"), (2, "Apache-2.0")}


def test_templates_from_files(spark, tmp_path):
    r = random.Random(2)
    full = [" ".join(r.choice(["you", "may", "not", "use", "the", "work", "except", "as", "licensor", "grants"]) + str(r.randrange(9)) for _ in range(1500)) for _ in range(2)]
    for name, text in zip(("Long-1.0", "Long-2.0"), full):
        (tmp_path / f"{name}.txt").write_text(text)
    templates = li.read_templates(spark, str(tmp_path))
    assert templates == tuple(zip(("Long-1.0", "Long-2.0"), full))
    text = "before it\n" + full[1].replace(" ", "\n", 90) + "\nand after it"
    assert [(x.doc_id, x.license) for x in li.licenses(docs(spark, [(1, text), (2, text[:200])]), templates, windows=True).collect()] == [(1, "Long-2.0")]


def planted(rng, text, edits):
    """A notice with a share of its words changed, wrapped as a comment between lines of prose."""
    prose = lambda n: " ".join(rng.choice(["river", "the", "of", "software", "under", "copy", "stone", "walks", "license", "to", "any", "person"]) for _ in range(n))
    words = [rng.choice(["river", "stone", "walks"]) if rng.random() < edits else w for w in text.split()]
    lines, width = [""], rng.randint(40, 90)
    for w in words:
        lines[-1] = f"{lines[-1]} {w}".strip()
        if len(lines[-1]) > width:
            lines.append("")
    return "\n".join([prose(30), "#", *(f"# {x}" for x in lines), "#", prose(40), "", prose(12)])


def test_recall_and_precision_on_planted_notices():
    """Every template, short and full, with up to 4 % of its words changed; and texts of the same words without any notice."""
    rng = random.Random(17)
    syllables = ["con", "di", "tion", "li", "cen", "see", "war", "ran", "ty", "dis", "tri", "bu", "pa", "tent"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    full = tuple((f"Full-{k}", " ".join(rng.choice(vocabulary) for _ in range(1500 + 700 * k))) for k in range(3))
    templates = li.TEMPLATES + li.MORE_TEMPLATES + full
    known = li.Templates(templates, li.THRESHOLD, windows=True)
    hits = wrong = total = 0
    for name, text in templates:
        for edits in (0.0, 0.02, 0.04):
            for _ in range(3):
                found = {k for k, _, _ in known.scan(planted(rng, text, edits if len(text.split()) > 25 else 0.0))}
                total += 1
                hits += name in found
                wrong += len(found - {name})
    shuffled = [" ".join(rng.sample(text.split(), len(text.split()))) for _, text in templates if len(text.split()) > 25]
    assert not any(known.scan(planted(rng, x, 0.0)) for x in shuffled)
    assert hits / total >= 0.98 and wrong / (hits + wrong) <= 0.03, (hits, wrong, total)
