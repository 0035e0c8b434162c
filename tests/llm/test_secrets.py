import base64
import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from parcelog.llm import secrets, spans
from tests.llm.util import ODD, docs

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    found = []
    for kind, (name, m, least, group) in enumerate((("assign", ASSIGN, 6, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile("[0-9a-f]+"), 24, 0))):
        found += [(x.start(), kind, x.end(), name) for x in m.finditer(text or "") if len(x[group]) >= least]
    return sorted(found)


def texts():
    r = random.Random(3)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    keys = [base64.b64encode(r.randbytes(30)).decode() for _ in range(40)]
    words = ["the", "configuration_of_the_server", "documentation", "establishment-of-counter.values", "naïve", "é😀"]
    rows = []
    syllables = ["con", "fi", "gu", "ra", "tion", "ser", "ver", "state", "_to_", "-", "ment", "Load", "er", ".", "HTTP", "Json", "Index", "KEY", "MAX", "With", "Queue", "By", "User", "Zip"]
    words += ["".join(r.choice(syllables) for _ in range(r.randrange(3, 10))) for _ in range(3000)]
    for i in range(150):
        parts = [r.choice(words) for _ in range(r.randrange(80))]
        for _ in range(r.randrange(3)):
            parts.insert(r.randrange(len(parts) + 1), r.choice([f'TOKEN = "{r.choice(hexes)}"', f"api_key:{r.choice(keys)}", f"AKIA{'Q7' * r.randrange(12)}", r.choice(hexes)[: r.randrange(20, 40)], "password=short", "passWord='longer1'", "secret: token: abcdefg"]))
        rows.append((i, " ".join(parts)))
    return rows, keys


def test_scan(spark):
    rows, keys = texts()
    bare = [(1000 + i, f"é see {k} there") for i, k in enumerate(base64.b64encode(random.Random(i).randbytes(30)).decode() for i in range(4))]
    r = random.Random(9)
    known = [(2000 + i, " ".join(f"api_key: {base64.b64encode(r.randbytes(30)).decode()}" for _ in range(20))) for i in range(20)]
    rows = rows + ODD + bare + known + [(None, "ſecret=abcdefgh toKen=abcdefgh"), (2, "x" * 50 + "0" * 24)]
    table = docs(spark, rows).withColumn("base_", F.lit(1)).withColumn("spans", F.lit(2))
    got = secrets.scan(table, threshold=-1.0).collect()  # few samples, and the keys to find are among those of identifiers
    assert len(got) == len(rows)
    left = sorted((tuple(r)[:5] for r in got), key=str)
    right = []
    for d, t in rows:
        b = brute(t)
        right.append((d, *[sum(x[1] == k for x in b) for k in range(3)], hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in b).encode()).hexdigest()))
    assert left == sorted(right, key=str)
    found = {r.doc_id: r.spans for r in got if r.doc_id is not None}
    assert [found[1000 + i] for i in range(4)] == ["markov:6:46"] * 4
    assert not any("markov" in found[d] for d, t in texts()[0] if not brute(t) and not re.search("[A-Z0-9]{8}|[0-9a-f]{16}", t))
    assert secrets.scan(docs(spark, [])).count() == 0


def test_redact(spark):
    rows, _ = texts()
    rows += ODD
    table = docs(spark, rows).withColumn("base_", F.lit("mine"))
    got = secrets.redact(table)
    assert got.columns == table.columns
    masked = got.collect()
    assert len(masked) == len(rows) and {r.base_ for r in masked} == {"mine"}
    assert not any(brute(r.text) for r in masked if "secret]" in (r.text or "") and "token: [" not in r.text)
    assert all(r.n_chars == len(r.text or "") for r in masked)
    clean = sorted((str(t) for _, t in rows if not brute(t)))
    assert len(set(clean) & {str(r.text) for r in masked}) >= 0.95 * len(set(clean))


def corpus(unlabelled):
    """Texts of repeated words and labelled secrets, and as many different unlabelled random strings as asked."""
    r = random.Random(11)
    rows, _ = texts()
    key = lambda: base64.b64encode(r.randbytes(30)).decode()
    rows += [(3000 + i, " ".join(f"api_key: {key()}" for _ in range(5))) for i in range(40)]
    return rows + [(4000 + i, " ".join(key() for _ in range(10))) for i in range(unlabelled // 10)]


def test_unlabelled_random_strings_do_not_train_identifiers(spark):
    r = random.Random(12)
    bare = [(9000 + i, f"see {base64.b64encode(r.randbytes(30)).decode()} there") for i in range(50)]
    found = {x.doc_id: x.spans for x in secrets.scan(docs(spark, corpus(2000) + bare)).collect()}
    assert sum(found[9000 + i] == "markov:4:44" for i in range(50)) >= 48


def test_parts_of_runs(spark):
    r = random.Random(13)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    head = "configuration_of_the_server/documentation/establishment-of-counter.values/"
    keys = [(key(40), key(40)) for _ in range(30)]
    rows = [(9000 + i, f"see {head}{a} there") for i, (a, _) in enumerate(keys)]
    rows += [(9100 + i, f"é AKIA{'Q7' * 8}/{a}") for i, (a, _) in enumerate(keys)]
    rows += [(9200 + i, f"{head}{a}/{head}{b}") for i, (a, b) in enumerate(keys)]
    rows += [(9300, f"see {head} there {head * 3}")]
    found = {x.doc_id: [tuple(map(int, s.split(":")[1:])) for s in x.spans.split(",") if s.startswith("markov")] for x in secrets.scan(docs(spark, corpus(0) + rows)).collect()}
    covered = lambda spans, start: sum(max(0, min(z, start + 40) - max(a, start)) for a, z in spans) >= 36
    assert sum(covered(found[9000 + i], 4 + len(head)) for i in range(30)) >= 25
    assert sum(covered(found[9100 + i], 23) for i in range(30)) >= 25
    assert sum(covered(found[9200 + i], len(head)) and covered(found[9200 + i], 41 + 2 * len(head)) for i in range(30)) >= 25
    assert found[9300] == [] and all(z - a <= 60 for k in (9000, 9200) for i in range(30) for a, z in found[k + i])


def test_cuts_change_nothing(spark, monkeypatch):
    """Texts cut at every place where that is allowed give the base spans of whole texts."""
    r = random.Random(21)
    bits = ["token", "Secret", "api_key", "key", "passwd", "=", ":", " ", "  ", '"', "'", ",", "\n", "é", "a1b2c3d4" * 3, "AKIA" + "Z9" * 9, "abcdefg", "x", "/", "_", "=="]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(1, 40)))) for i in range(3000)]
    monkeypatch.setattr(spans, "PIECE", 1)
    got = {x.doc_id: tuple(x)[1:5] for x in secrets.scan(docs(spark, rows)).collect()}
    for d, t in rows:
        b = brute(t)
        assert got[d] == (*[sum(x[1] == k for x in b) for k in range(3)], hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in b).encode()).hexdigest()), t
    assert sum(any(v[:3]) for v in got.values()) > 1000


def test_recall_and_false_alarms_at_the_default_threshold(spark):
    """Unlabelled keys planted in prose are found, identifiers are left alone, with a model of the corpus itself."""
    r = random.Random(31)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(r.choice(letters) for _ in range(r.choice([24, 32, 40]))) for _ in range(300)]
    names = ["_".join(r.choice(["load", "configuration", "server", "statement", "queue", "by", "user", "counter", "index", "the", "establish", "document"]) for _ in range(4)) for _ in range(300)]
    names = [n for n in names if len(n) >= 20]
    found = {x.doc_id: x.spans for x in secrets.scan(docs(spark, corpus(500) + [(20_000 + i, f"see {k} there") for i, k in enumerate(keys)] + [(30_000 + i, f"see {n} there") for i, n in enumerate(names)])).collect()}
    recall = sum(found[20_000 + i] == f"markov:4:{4 + len(k)}" for i, k in enumerate(keys)) / len(keys)
    alarms = sum("markov" in found[30_000 + i] for i in range(len(names))) / len(names)
    assert recall >= 0.97 and alarms <= 0.02, (recall, alarms)


def test_long_text_of_many_runs(spark):
    """Work grows with the text, not with the square of its spans."""
    r = random.Random(41)
    runs = [r.randbytes(16).hex()[:31] for _ in range(64_000)]
    for text in (" ".join(runs), ":".join(runs)):
        began = time.time()
        [row] = secrets.scan(docs(spark, [(1, text)])).collect()
        assert row.n_hex == 64_000 and row.spans.endswith(f":{len(text)}") and time.time() - began < 60


def test_base_spans_in_long_runs_equal_brute_force(spark):
    """Short access words inside long runs, hex near its bound, in texts of one and of many pieces."""
    r = random.Random(41)
    bits = ["AKIA", "AKIABUILD", "AKIA" + "Q7" * 7 + "X", "AKIA" + "Q7" * 8, "AKIA" + "Z" * 20, "/srv/", "/releases/", "2024", "_name", "-x", "lower", "UPPER", "a1" * 11 + "b", "a1" * 12, "0f" * 15, "token=", "secret: ", " ", " ", "\n", "é", "'", '"']
    rows = [(i, "".join(r.choice(bits) for _ in range(r.choice([5, 12, 30, 1500])))) for i in range(300)]
    rows.append((1000, "path /srv/AKIABUILD/releases/2024 ok"))
    got = {x.doc_id: tuple(x)[1:5] for x in secrets.scan(docs(spark, rows)).collect()}
    for d, t in rows:
        b = brute(t)
        assert got[d] == (*[sum(x[1] == k for x in b) for k in range(3)], hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in b).encode()).hexdigest()), t[:200]
    assert sum(len(t) > 3000 for _, t in rows) > 40 and sum(v[1] for v in got.values()) > 100


def test_redact_leaves_short_access_words(spark):
    text = "path /srv/AKIABUILD/releases/2024 ok"
    assert secrets.redact(docs(spark, [(1, text)])).first().text == text
