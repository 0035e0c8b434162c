import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parcelog.llm import simhash
from parcelog.llm.hot import join_hot
from tests.llm.util import ODD, docs


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBz É\t\n\x0b\x85 .", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    rows = [(1, "one two three four"), (2, "É ü")]
    got = docs(spark, rows).select(F.xxhash64("text").alias("h")).collect()
    assert [r.h % 2**64 for r in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for _, t in rows]


def test_code_is_perfect():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 2000).astype(np.uint32)
    r = simhash.LOW[v & 0xFFF] ^ simhash.HIGH[v >> 12]
    word = v ^ simhash.LEADER[r]
    assert (np.bitwise_count(word ^ v) <= 3).all() and not (simhash.LOW[word & 0xFFF] ^ simhash.HIGH[word >> 12]).any()
    assert len(set(simhash.LEADER.tolist())) == 2048


def test_every_link_has_a_common_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(k)
    keys = []
    for fps in (a, b):
        rows, own = simhash.keys_of(fps)
        found = [set() for _ in fps]
        for r, k in zip(rows.tolist(), own.tolist()):
            found[r].add(k)
        keys.append(found)
    assert all(x & y for x, y in zip(*keys))


def near(rng, base, n):
    """Texts whose fingerprints are near each other: one word of a long text changed."""
    words = base.split()
    out = []
    for _ in range(n):
        w = list(words)
        w[rng.integers(len(w))] = f"w{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        base = " ".join(f"x{rng.integers(5000)}" for _ in range(60))
        texts += [base, *near(rng, base, 14)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + ODD + [(None, texts[0]), (None, "only null"), (7, texts[0])]
    got = simhash.near_duplicates(docs(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_large_keys_meet_in_blocks(spark):
    rng = np.random.default_rng(5)
    center = rng.integers(0, 2**63, 4, dtype=np.int64)
    fps = np.unique(np.concatenate([c ^ (np.int64(1) << rng.integers(0, 22, 300)) ^ (np.int64(1) << rng.integers(0, 22, 300)) for c in center]))
    links = simhash._links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), block=16)
    got = {r.node: r.root for r in simhash.connected_components(links).collect()}
    u = fps.view(np.uint64)
    near_ = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.where(near_, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert [got.get(int(x), int(x)) for x in fps] == [int(fps[k]) for k in label]


def test_keep_one(spark):
    rows = [(5, "a b c d e"), (3, "A B c d e"), (3, "A B c d e"), (None, "a b c d e"), (9, "something else here now"), (None, "null only text x"), (None, "null only text x")]
    kept = simhash.keep_one(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, "A B c d e"), (9, "something else here now"), (None, "null only text x")], key=str)


def test_keys_widen_with_the_number_of_fingerprints():
    assert [simhash.decoded_for(10**k) for k in (3, 6, 8, 10, 14)] == [2, 2, 2, 1, 0]
    rng = np.random.default_rng(6)
    a = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(k)
    for decoded, most, _ in simhash.KEYS:
        found = []
        for fps in (a, b):
            rows, keys = simhash.keys_of(fps, decoded)
            assert len(np.unique(rows << 48 ^ keys)) == len(rows) <= len(fps) * most * 1.1 and keys.max() < 1 << 46
            found.append(set(zip(rows.tolist(), keys.tolist())))
        assert {i for i, _ in found[0] & found[1]} == set(range(len(a)))  # each link has a common key


def test_components_with_wide_keys(spark):
    rng = np.random.default_rng(7)
    center = rng.integers(0, 2**63, 5, dtype=np.int64)
    fps = np.unique(np.concatenate([c ^ (np.int64(1) << rng.integers(0, 60, 40)) ^ (np.int64(1) << rng.integers(0, 60, 40)) for c in center]))
    table = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    found = [{r.node: r.root for r in simhash.connected_components(simhash._links(table, decoded=d)).collect()} for d in (2, 1, 0)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 150


def test_keep_one_leaves_clashing_columns(spark):
    table = docs(spark, [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, None), (4, "")])
    for name in ("text_hash_", "none_", "ID_", "hash_", "root", "fp", "n", "component_id"):
        table = table.withColumn(name, F.lit(f"my {name}"))
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == [1, 3] and all(r[c] == f"my {c}" for r in rows for c in table.columns[5:])


def test_join_hot(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 3000 + list(range(2, 1500)) + [None])], "k long, i int")
    right = left.filter("k % 2 = 1").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("m"))
    for how in ("inner", "left"):
        got = join_hot(left, right, "k", left.count(), how)
        expected = left.join(right.drop("n"), "k", how)
        assert got.columns == ["k", "i", "m"] and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
