import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from parcelog.llm import frames, packing
from parcelog.llm.tokens import encoder
from parcelog.storage import scratch_path
from tests.llm.util import ODD, docs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB .,'!\n\t\x0b\x1c\x85 É́Iİßſ१<|>"), st.characters(codec="utf-8")), max_size=40))
def test_word_memo_equals_library(text):
    assert np.frombuffer(encoder(PATH).encode([text])[0], "<u4").tolist() == ids_of(text)


def test_memo_keeps_contractions_whole():
    texts = ["dog' 20.2", "dog', 20.2, é’ é’,", "dog'," * 3, "don't", "don't."]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(PATH).encode(texts[:1]) + encoder(PATH).encode(texts)] == [ids_of(t) for t in texts[:1] + texts]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1), st.just(40))
def test_plan_is_gapless_and_whole(counts, capacity):
    segments = packing.plan_bins(dict(counts), capacity)
    filled = collections.defaultdict(list)
    for length, n in counts.items():
        own = segments[segments[:, 0] == length]
        for rank in range(n):
            s = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            nth = rank - s[1]
            filled[s[3] + nth // s[2]].append((s[4] + nth % s[2] * length, length))
    for items in filled.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity


def test_fullest_is_optimal_with_the_longest():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(1, 30, 9).tolist()
        counts = collections.Counter(lengths)
        best = max(s for m in range(1 << 9) if (own := [x for i, x in enumerate(lengths) if m >> i & 1]) and max(own) == max(lengths) and (s := sum(own)) <= 50)
        used = packing.fullest(dict(counts), 50)
        assert sum(k * n for k, n in used.items()) == best and all(counts[k] >= n for k, n in used.items())


def test_pack_odd_documents(spark):
    rows = packing.pack(spark, docs(spark, ODD), PATH).collect()
    expected = collections.Counter()
    for doc_id, text in ODD:
        ids = [*ids_of(text), 0]
        for i, a in enumerate(range(0, len(ids), 2048)):
            piece = ids[a : a + 2048]
            expected[(doc_id, i, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == expected
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for items in places.values():
        assert [o for o, _ in sorted(items)] == np.cumsum([0, *[n for _, n in sorted(items)][:-1]]).tolist()
        assert sum(n for _, n in items) <= 2048
    total = sum(r.length for r in rows)
    assert len(places) <= -(-total // 2048) + 1
    assert packing.pack(spark, docs(spark, []), PATH).count() == 0


def test_token_files_round_trip(spark):
    got = frames.token_files(spark, docs(spark, ODD).withColumn("start", __import__("pyspark").sql.functions.lit("clash")), PATH).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d or 0))
    expected = collections.Counter((d, len(i := [*ids_of(t), 1]), zlib.crc32(np.array(i, "<u4").tobytes())) for d, t in ODD)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    assert frames.token_files(spark, docs(spark, []), PATH).count() == 0


def test_reader_takes_single_documents_and_finds_damage(spark, tmp_path):
    rows = [(i, f"number {i} of many words " * (i % 7 * 300)) for i in range(60)]
    manifest = frames.write_token_files(docs(spark, rows).coalesce(1), f"file://{tmp_path}/t", PATH)
    wanted = {3, 41, 59}
    found = [x for r in manifest.collect() for x in frames.read_documents(r.path, [*wanted, 1000])]
    assert {d: i for d, i in found} == {d: [*ids_of(rows[d][1]), 1] for d in wanted}
    path = manifest.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[20] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception):  # noqa: B017 - the frame's own checksum or the table's
        list(frames.ShardReader(__import__("pyarrow").fs.LocalFileSystem().open_input_file(path)).documents(range(5)))


def test_small_shards_and_single_documents(spark):
    rows = [(i, f"document {i} " + "word " * (i % 7)) for i in range(300)] + ODD
    table = docs(spark, rows)
    manifest = frames.write_token_files(table, scratch_path(spark, "small"), PATH, shard_bytes=400)
    parts = manifest.collect()
    assert len(parts) > 20 and all(r.n_tokens * 4 <= 400 or r.n_docs == 1 for r in parts) and sum(r.n_docs for r in parts) == len(rows)
    whole = frames.read_token_files(frames.write_token_files(table, scratch_path(spark, "one"), PATH))
    assert sorted(map(tuple, frames.read_token_files(manifest).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    got = frames.find_documents(manifest, [250, 17, 3, 10**9])
    assert [d for d, _ in got] == [3, 3, 3, 17, 250] and all(ids[-1] == 1 for _, ids in got)


def test_shards_of_few_documents(spark):
    """A shard closes after so many documents, however short they are."""
    manifest = frames.write_token_files(docs(spark, [(i, "") for i in range(100)]), scratch_path(spark, "few"), PATH, shard_documents=7)
    parts = manifest.collect()
    assert sum(r.n_docs for r in parts) == 100 and max(r.n_docs for r in parts) == 7
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in frames.read_token_files(manifest).collect()) == [(i, i, 1) for i in range(100)]
