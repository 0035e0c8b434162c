"""Trigrams of whole words: a modified Kneser-Ney model of the third order for each language, without a bound on its words.

A text is its words between two marks of its beginning and one of its end. Counts, continuation
counts, discounts and weights are those of interpolated modified Kneser-Ney smoothing; below
single words every word, and one never seen, is as likely. Most trigrams of words stand in one
text only, so a model that has seen a text knows it by heart, junk as well as prose. Therefore a
language's different texts are dealt into two halves, each half has a model of all its texts, and
a text is measured by the model of the other half. A text's half is a bit of the least hash of its
trigrams, so that most near copies of a text are in its half. Behind a context that a model never saw it
takes the shorter one's probability.

The model is as large as its texts, so no task holds it. A trigram goes to the part of its
*middle* word: there all trigrams with that word meet, and with them whatever the counts of
(first, middle), of (middle, last) and of the middle word alone are made of. Parts hold about
``PART_WORDS`` trigrams. Middle words that alone would fill a part are dealt on by the first
word; the counts of their pairs (middle, last) are then added up by Spark and sent to their
parts. How many words a single word follows is read in ascending slices.

The texts are read once: their base counts are taken, and texts that pass are written as blocks of
word numbers (``coded``), of which each step reads. A number is a word's rank among the ``NUMBERED``
words that are most frequent in one text of ``SHOWN``, or stands for a hash that the block lists; that
says how a word is written, not what comes out. Tasks send a part's trigrams in such blocks, too, and
Spark groups them. The parts are worked on in ``ROUNDS`` rounds, so that only a share of the trigrams
lies on disk at a time. The first rounds count, the others score. A task sends a text once, and
a part takes equal texts of several tasks once.

Words are known by 64-bit hashes that their language seeds. Logarithms are added as integers
(units of 1 / ``UNIT``), so sums don't depend on their order.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelog.llm.frames import open_uri
from parcelog.storage import materialize, scratch_path, small_batches

PART_WORDS, ROUNDS = 900_000, 6
#: Bytes of texts that a task gathers before it writes them, and of blocks that it takes at a time.
BLOCK_BYTES, BATCH_BYTES = 4 << 20, 4 << 20
#: One text in so many shows which words are frequent; that only says where they are sent and how they are written.
SHOWN = 16
#: Most words that have a number of their own, of all languages.
NUMBERED = 1 << 18
#: Words that are more than half of 1 / 2 ** SHARE of all have parts of their own even where they would not fill one.
SHARE = 7
#: Slices in which the counts of words are summed.
SLICES = 3
UNIT = 1e7
#: Texts that a task remembers, and languages whose places it keeps.
KEPT, LANGUAGES = 1 << 20, 8
BEGIN, END = b" ", b"\n"
#: From the numbers of words and of words in repeated windows: whether texts count.
Passes = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: kind 3 and 2: n trigrams or pairs of a half have the count a (4: four; more don't matter); 1: word a follows n words in the first half and b in the second; 0: pair (a, b) follows n words.
COUNTS = "lang string, kind int, half int, a long, b long, n long"


def discounts(*having: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from how many have a count of 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (max(1, int(n)) for n in having)
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 1, 2, 3])


def codes(lang: str, words: list[bytes]) -> np.ndarray:
    """Hashes of a language's words."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def half(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The half of each text, of whose trigrams' hashes the first stand at ``starts``."""
    return (np.minimum.reduceat(code, starts) >> np.uint64(8)).astype(np.int64) & 1


class Places:
    """Where trigrams go: ``parts`` of each language, and the frequent middle words with their first part and number of parts."""

    def __init__(self, parts: dict[str, int], frequent: list[tuple[str, int, int]], rounds: int) -> None:
        self.rounds, self.parts, self.frequent = rounds, parts, {}
        after = dict(parts)
        for lang, code, n in sorted(frequent):
            self.frequent.setdefault(lang, []).append((code, after[lang], n))
            after[lang] += n

    def rows(self) -> list[tuple[str, int, int, int]]:
        return [(lang, code - (code >> 63 << 64), first, n) for lang, own in self.frequent.items() for code, first, n in own]

    def of(self, lang: str, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first part and the number of parts of each middle word; among several the first word's hash chooses."""
        start, parts = (_mix(code, np.uint64(1)) % np.uint64(self.parts[lang])).astype(np.int32), np.ones(len(code), np.int32)
        for own, first, n in self.frequent.get(lang, []):  # few: each would fill a part
            at = code == np.uint64(own)
            start[at], parts[at] = first, n
        return start, parts


def repeated(word: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Whether each word is within a window of words that its text has twice or more; texts stand one after another."""
    n = len(word) - window + 1
    covered = np.zeros(len(word) + 1, np.int64)
    if n > 1:
        own = np.flatnonzero(text[:n] == text[window - 1 :])
        h = text[:n].astype(np.uint64)
        for k in range(window):
            h = _mix(h, word[k : k + n])
        h = h[own]
        ordered = np.sort(h)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        hit = own[twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h] if len(twice) else own[:0]
        covered += np.bincount(hit, minlength=len(word) + 1) - np.bincount(hit + window, minlength=len(word) + 1)
    return np.cumsum(covered)[:-1] > 0


def packed(*values: np.ndarray) -> bytes:
    """Arrays as one compressed row, equal bytes of an array's values side by side; upper bytes that are all zero compress to nothing."""
    raw = b"".join(np.ascontiguousarray(v.view(np.uint8).reshape(-1, v.itemsize).T).tobytes() for v in values)
    return np.array([len(v) for v in values], np.int64).tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(data: pa.Buffer, *kinds: type) -> list[np.ndarray]:
    """The arrays of ``packed``, of these types."""
    sizes = np.frombuffer(data, np.int64, len(kinds))
    ends = np.cumsum([0, *(n * np.dtype(kind).itemsize for n, kind in zip(sizes, kinds, strict=True))])
    raw = np.frombuffer(pa.Codec("zstd").decompress(data[8 * len(kinds) :], int(ends[-1])), np.uint8)
    return [raw[i:j].reshape(np.dtype(kind).itemsize, -1).T.copy("C").view(kind).ravel() for i, j, kind in zip(ends[:-1], ends[1:], kinds, strict=True)]


#: Hashes of each language's words that are frequent in the texts shown, and how often they stand there, in descending order.
Frequent = dict[str, tuple[np.ndarray, np.ndarray]]


class Numbers:
    """Ranks of each language's frequent words; the marks come first. Other words have higher numbers, which a block's list explains."""

    def __init__(self, frequent: Frequent) -> None:
        self.ranked = {lang: np.concatenate([marks := codes(lang, [BEGIN, END]), own[~np.isin(own, marks)]]) for lang, (own, _) in frequent.items()}

    def codes(self, lang: str) -> np.ndarray:
        return self.ranked[lang] if lang in self.ranked else codes(lang, [BEGIN, END])

    def of(self, lang: str, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each of different ``code``, and the hashes of those without a rank."""
        ranked = self.codes(lang)
        order = np.argsort(ranked)
        at = order[np.minimum(np.searchsorted(ranked, code, sorter=order), len(ranked) - 1)]
        known = ranked[at] == code
        return np.where(known, at, len(ranked) + np.cumsum(~known) - 1).astype(np.int32), code[~known]


def frequent_words(texts: DataFrame, shown: int = SHOWN) -> Frequent:
    """The at most ``NUMBERED`` words that are most frequent in one text of ``shown`` (key: even, lang, text: not null)."""
    each = texts.filter(F.pmod("key", F.lit(2 * shown)) < 2).select("lang", F.explode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("word")).filter("word <> ''")
    with dropped(each.sparkSession, "words-shown") as folder:
        each.groupBy("lang", "word").agg(F.count("*").alias("n")).write.parquet(folder)
        often = each.sparkSession.read.schema("lang string, word string, n long").parquet(folder)
        sizes = sorted(often.groupBy(F.least("n", F.lit(NUMBERED)).alias("n")).agg(F.count("*").alias("words")).collect(), reverse=True)  # a row for each number
        least = min((r["n"] for r, upto in zip(sizes, np.cumsum([r["words"] for r in sizes]), strict=True) if upto <= NUMBERED), default=NUMBERED)
        table = often.filter(F.col("n") >= least).toArrow()
    out = {}
    for lang in pc.unique(table["lang"]).to_pylist():
        own = table.filter(pc.equal(table["lang"], lang))
        code, n = codes(lang, own["word"].cast(pa.binary()).to_pylist()), np.asarray(own["n"])
        code, at = np.unique(code, return_index=True)
        order = np.argsort(-n[at], kind="stable")
        out[lang] = code[order], n[at][order]
    return out


class Coder:
    """Texts of a task, as blocks of numbers: hashes of words without a rank, numbers of all words, keys and lengths of texts."""

    def __init__(self, ranks: Numbers, passes: Passes, window: int) -> None:
        self.ranks, self.passes, self.window = ranks, passes, window
        self.met: set[int] = set()

    def block(self, lang: str, keys: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes | None]:
        """Words and words in repeated windows of each text; the block of those that pass and weren't met before (even keys, from here on with their text's half)."""
        lists = pc.ascii_split_whitespace(texts)
        every = lists.flatten()
        text = np.repeat(np.arange(len(keys), dtype=np.int32), np.asarray(lists.value_lengths()))
        real = np.flatnonzero(np.asarray(pc.binary_length(every)))  # white space at an end leaves an empty word there
        named = every.dictionary_encode()
        word, text = np.asarray(named.indices)[real], text[real]
        code = codes(lang, named.dictionary.cast(pa.binary()).to_pylist())
        n = np.bincount(text, minlength=len(keys))
        repeat = np.bincount(text, repeated(code[word], text, self.window), len(keys)).astype(np.int64)
        new = np.zeros(len(keys), bool)
        for i in np.flatnonzero(self.passes(n, repeat)):
            if (key := int(keys[i])) not in self.met:
                if len(self.met) >= KEPT:
                    self.met.clear()
                self.met.add(key)
                new[i] = True
        if not new.any():
            return n, repeat, None
        word, keys, length = word[new[text]], keys[new], n[new]
        kinds, number = np.unique(word, return_inverse=True)
        number_of, others = self.ranks.of(lang, code[kinds])
        flat = marked(number_of[number], length)
        of_number = np.concatenate([self.ranks.codes(lang), others])
        first, middle, last = (of_number[flat[k : len(flat) - 2 + k]] for k in range(3))
        gram = _mix(_mix(first, middle), last)[begins(length)]
        keys = keys | half(gram, np.cumsum(length + 1) - length - 1)
        return n, repeat, packed(others, number_of[number], keys, length.astype(np.int32))


def marked(number: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Texts one after another, each with two marks before and one behind it."""
    flat = np.zeros(len(number) + 3 * len(length), np.int32)
    flat[np.arange(len(number)) + np.repeat(3 * np.arange(len(length)) + 2, length)] = number
    flat[np.cumsum(length + 3) - 1] = 1
    return flat


def begins(length: np.ndarray) -> np.ndarray:
    """Where trigrams begin among marked texts: at all places but a text's last two."""
    ends = np.cumsum(length + 3)
    here = np.ones(ends[-1], bool)
    here[ends - 1] = here[ends - 2] = False
    return np.flatnonzero(here)


def blocks(coded: DataFrame, ranks: Numbers, places: Places, turn: int) -> DataFrame:
    """The trigrams of the blocks ``coded`` (lang, data) whose parts' turn it is."""
    small_batches(coded.sparkSession, 512, BATCH_BYTES)

    def sent(lang: str, data: pa.Buffer, code: np.ndarray, start: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        ranked = len(code)
        others, number, keys, length = unpacked(data, np.uint64, np.int32, np.int64, np.int32)
        code = np.concatenate([code, others])
        start, parts = (np.concatenate(x) for x in zip((start, parts), places.of(lang, others), strict=True))
        flat = marked(number, length)
        at = begins(length)
        text = np.repeat(np.arange(len(keys), dtype=np.int32), length + 1)
        middle = flat[at + 1]
        part = start[middle]
        several = np.flatnonzero(parts[middle] > 1)
        part[several] += (_mix(code[flat[at[several]]], np.uint64(2)) % parts[middle[several]].astype(np.uint64)).astype(np.int32)
        now = np.flatnonzero((part + zlib.crc32(lang.encode()) % places.rounds) % places.rounds == turn)
        if not len(now):
            return
        small = part[now].astype(np.uint16) if part.max() < 1 << 16 else part[now]
        now = now[np.argsort(small, kind="stable")]
        part, at, text = part[now], at[now], text[now]
        own = np.stack([flat[at], flat[at + 1], flat[at + 2]])
        cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            words = own[:, i:j]
            rare = words >= ranked
            known, again = np.unique(words[rare], return_inverse=True)
            words[rare] = ranked + again
            held = np.flatnonzero(np.diff(text[i:j], prepend=-1))
            yield int(part[i]), packed(others[known - ranked], *words, keys[text[i:j][held]], np.diff(held, append=j - i).astype(np.int32))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[np.ndarray, ...]] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in known:
                    if len(known) == LANGUAGES:
                        known.clear()
                    code = ranks.codes(lang)
                    known[lang] = (code, *places.of(lang, code))
                rows = list(sent(lang, data.as_buffer(), *known[lang]))
                if rows:
                    part, out = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows)), pa.array(part, pa.int32()), pa.array(out, pa.binary())], names=["lang", "part", "data"])

    return coded.select("lang", "data").mapInArrow(send, "lang string, part int, data binary")


class Part:
    """The different trigrams and pairs of a part with their counts in each half, and the trigrams of its texts, all in the order of (middle, last, first)."""

    def __init__(self, lang: str, table: pa.Table, ranks: Numbers) -> None:
        read = [unpacked(x.as_buffer(), np.uint64, np.int32, np.int32, np.int32, np.int64, np.int32) for x in table["data"]]
        ranked = ranks.codes(lang)
        others, number = np.unique(np.concatenate([r[0] for r in read]), return_inverse=True)
        self.code = np.concatenate([ranked, others])
        start = 0
        for r in read:
            for words in r[1:4]:
                rare = words >= len(ranked)
                words[rare] = len(ranked) + number[start + words[rare] - len(ranked)]
            start += len(r[0])
        first, middle, last = (np.concatenate([r[k] for r in read]) for k in (1, 2, 3))
        every, length = (np.concatenate([r[k] for r in read]) for k in (4, 5))
        del read
        self.texts, text = np.unique(every, return_inverse=True)
        if len(self.texts) < len(every):  # of equal texts that several blocks hold, the first one
            chosen = np.empty(len(self.texts), np.int64)
            chosen[text[::-1]] = np.arange(len(every))[::-1]
            keep = np.repeat(chosen[text] == np.arange(len(every)), length)
            first, middle, last = first[keep], middle[keep], last[keep]
            text = np.repeat(text, length)[keep]
        else:
            text = np.repeat(text, length)
        bits = int(len(self.code)).bit_length()
        gram = middle.astype(np.int64) << bits | last
        kinds = None
        if 3 * bits > 63:
            kinds, gram = np.unique(gram, return_inverse=True)
        gram = gram << bits | first
        del first, middle, last
        order = np.argsort(gram)
        gram, self.text = gram[order], text[order].astype(np.int32)
        del order, text
        self.half = (self.texts & 1)[self.text].astype(np.int8)  # the key's last bit
        new = np.diff(gram, prepend=-1) != 0
        self.gram = (np.cumsum(new) - 1).astype(np.int32)
        gram = gram[new]
        self.n = np.stack([np.bincount(self.gram[self.half == h], minlength=len(gram)).astype(np.int32) for h in (0, 1)])
        self.first = gram & (1 << bits) - 1
        pair = gram >> bits
        new = np.diff(pair, prepend=-1) != 0
        self.pair = np.cumsum(new) - 1
        pair = pair[new] if kinds is None else kinds[pair[new]]
        self.n_pair = _summed(self.pair, self.n > 0)
        self.middle, self.last = pair >> bits, pair & (1 << bits) - 1

    def before(self) -> np.ndarray:
        """The number of each trigram's first two words."""
        return np.unique(self.middle[self.pair] << int(len(self.code)).bit_length() | self.first, return_inverse=True)[1]


def _summed(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of both halves' values by group."""
    return np.stack([np.bincount(group, own).astype(np.int32) for own in values])


def _smoothed(n: np.ndarray, context: np.ndarray, discount: list[np.ndarray], shorter: np.ndarray) -> np.ndarray:
    """Probabilities in both halves, from counts behind contexts and the shorter n-grams' probabilities."""
    out = np.empty(n.shape)
    for p, own, d, below in zip(out, n, discount, shorter, strict=True):
        off = d[np.minimum(own, 3)]
        total = np.bincount(context, own)
        seen = np.maximum(total, 1)
        weight = np.where(total > 0, np.bincount(context, off) / seen, 1.0)
        p[:] = (own - off) / seen[context] + weight[context] * below
    return out


def _count(places: Places, ranks: Numbers) -> Callable[[tuple, pa.Table], pa.Table]:
    def count(key: tuple, table: pa.Table) -> pa.Table:
        lang, number = key[0].as_py(), key[1].as_py()
        part = Part(lang, table, ranks)
        code = part.code.view(np.int64)
        whole = number < places.parts[lang]  # else other parts hold trigrams of these pairs, too
        out = []
        if whole:
            n = np.stack([np.bincount(part.last[own > 0], minlength=len(code)) for own in part.n_pair])
            own = np.flatnonzero(n.any(axis=0))
            out.append((np.ones(len(own)), np.zeros(len(own)), code[own], n[1, own], n[0, own]))
        for half in (0, 1):
            if not whole:
                own = np.flatnonzero(part.n_pair[half])
                out.append((np.zeros(len(own)), np.full(len(own), half), code[part.middle[own]], code[part.last[own]], part.n_pair[half, own]))
            for kind, counts in [(3, part.n), (2, part.n_pair)][: 1 + whole]:
                size = np.arange(1, 5)
                out.append((np.full(4, kind), np.full(4, half), size, size * 0, [(counts[half] == k).sum() for k in size]))
        columns = [np.concatenate([np.asarray(v).astype(np.int64) for v in x]) for x in zip(*out, strict=True)]
        kind, half = (x.astype(np.int32) for x in columns[:2])
        return pa.table({"lang": pa.array([lang] * len(kind), pa.string()), "kind": kind, "half": half, **dict(zip("abn", columns[2:], strict=True))})

    return count


def followers(folder: str, words: np.ndarray) -> np.ndarray:
    """How many different words each of different ``words`` follows in each half: what the slices below ``folder`` say."""
    fs, path = open_uri(folder)
    out = np.zeros((2, len(words)), np.int64)
    order = np.argsort(words)
    words = words[order]
    for file in fs.get_file_info(pafs.FileSelector(path)):
        if file.base_name.startswith("part-"):
            with fs.open_input_file(file.path) as source:
                slice_ = pq.read_table(source, use_threads=False)
            code = np.asarray(slice_["a"])
            if len(code):
                i, j = np.searchsorted(words, code[0]), np.searchsorted(words, code[-1], "right")
                at = np.searchsorted(code, words[i:j])
                own = np.flatnonzero(code[at] == words[i:j])
                for half in (0, 1):
                    out[half, order[i + own]] = np.asarray(slice_[f"n{half}"])[at[own]]
    return out


@contextmanager
def dropped(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder below the shared one that goes in the end: its tables make room for what comes after."""
    folder = scratch_path(spark, name)
    yield folder
    fs, path = open_uri(folder)
    fs.delete_dir(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the action that wrote them ends, so a round's blocks make room for the next."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def log_probability(coded: DataFrame, frequent: Frequent, words: dict[str, int], part_words: int = PART_WORDS, rounds: int = ROUNDS, shown: int = SHOWN) -> DataFrame:
    """key and log_probability of each different text of the blocks ``coded`` (lang, data), by the model of the other half of them in its
    language, if that has any; ``words`` has about as many words as each language has. Arguments say how the work is cut, not what comes out."""
    spark = coded.sparkSession
    total = sum(words.values())
    rounds = max(1, min(rounds, -(-total // part_words)))
    ranks = Numbers(frequent)
    often, least = [], min(part_words, max(total >> SHARE, part_words >> 4))  # two for each part's words at most
    for lang, (code, n) in frequent.items():
        own = np.flatnonzero((n * shown * 2 > least) & (lang in words) & (total > part_words))
        often += [(lang, c, -(-k * shown * 2 // part_words)) for c, k in zip(code[own].tolist(), n[own].tolist(), strict=True)]
    places = Places({lang: max(1, -(-n // part_words)) for lang, n in words.items()}, often, rounds)

    def by_part(turn: int):
        return blocks(coded, ranks, places, turn).groupBy("lang", "part")

    folder = scratch_path(spark, "words-before")
    found: dict[str, np.ndarray] = {}
    with shuffles_dropped(spark), dropped(spark, "word-counts") as counts:
        for turn in range(rounds):
            by_part(turn).applyInArrow(_count(places, ranks), COUNTS).write.parquet(f"{counts}/round={turn}")
        every = spark.read.schema(COUNTS).parquet(counts)
        pairs = materialize(every.filter("kind = 0").groupBy("lang", "half", "a", "b").agg(F.sum("n").alias("n")), "frequent-pairs")
        in_half = [F.when(F.col("half") == half, 1).otherwise(0).cast("long").alias(f"n{half}") for half in (0, 1)]
        single = every.filter("kind = 1").select("lang", "a", F.col("n").alias("n0"), F.col("b").alias("n1")).unionByName(pairs.select("lang", F.col("b").alias("a"), *in_half))
        with dropped(spark, "word-followers") as sums:
            for turn in range(SLICES):  # one shuffle's files at a time
                own = single.filter(F.pmod("a", F.lit(SLICES)) == turn)
                own.groupBy("lang", "a").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).write.parquet(f"{sums}/slice={turn}")
            summed = spark.read.schema("lang string, a long, n0 long, n1 long").parquet(sums)
            summed.filter("n0 > 0 and n1 > 0").select("a", "n0", "n1").repartitionByRange("a").sortWithinPartitions("a").write.parquet(folder)  # else no text asks for it

            of_pairs = pairs.filter("n <= 4").groupBy("lang", F.lit(2).alias("kind"), "half", F.col("n").alias("a")).agg(F.count("*").alias("n"))
            sizes = every.filter("kind >= 2").groupBy("lang", "kind", "half", "a").agg(F.sum("n").alias("n")).unionByName(of_pairs)
            for half in (0, 1):
                own = summed.filter(F.col(f"n{half}") > 0).withColumn("n", F.col(f"n{half}"))
                sizes = sizes.unionByName(own.groupBy("lang", F.lit(1).alias("kind"), F.lit(half).alias("half"), F.least("n", F.lit(5)).alias("a")).agg(F.count("*").alias("n")))
                sizes = sizes.unionByName(own.groupBy("lang", F.lit(0).alias("kind"), F.lit(half).alias("half"), F.lit(0).cast("long").alias("a")).agg(F.sum("n").alias("n")))
            for r in sizes.collect():  # five rows or less for each language, half and length
                found.setdefault(r["lang"], np.zeros((4, 2, 6), np.int64))[r["kind"], r["half"], r["a"]] += r["n"]

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "log": pa.array([], pa.int64())})
        lang = left["lang"][0].as_py()
        part, sizes = Part(lang, left, ranks), found[lang]
        code = part.code.view(np.int64)
        d1, d2, d3 = ([discounts(*own[1:5]) for own in sizes[k]] for k in (1, 2, 3))
        asked = np.flatnonzero(np.bincount(part.last, minlength=len(code)))
        before = followers(folder, code[asked])
        p1 = np.zeros((2, len(code)))
        for half, (d, own, size, total) in enumerate(zip(d1, before, sizes[1], np.maximum(sizes[0, :, 0], 1), strict=True)):
            rest = (d[1:4] * [size[1], size[2], size[3:].sum()]).sum() / total
            p1[half, asked] = (own - d[np.minimum(own, 3)]) / total + rest / (size.sum() + 1)
        p1 = p1[:, part.last]
        if right.num_rows:  # all pairs of the one frequent word of this part, of which other texts may have more
            half, word, n = (np.asarray(right[c]) for c in ("half", "word", "n"))
            last = code[part.last]
            known = np.unique(np.concatenate([word, last]))
            counts = np.zeros((2, len(known)), np.int64)
            counts[half, np.searchsorted(known, word)] = n
            at = np.searchsorted(known, last)
            lower = np.zeros((2, len(known)))
            lower[:, at] = p1
            p2 = _smoothed(counts, np.zeros(len(known), np.int64), d2, lower)[:, at]
        else:
            p2 = _smoothed(part.n_pair, np.cumsum(np.diff(part.middle, prepend=-1) != 0) - 1, d2, p1)
        p3 = _smoothed(part.n, part.before(), d3, p2[:, part.pair])
        other = 1 - part.half
        log = np.rint(np.log(np.maximum(p3, 1e-300)) * UNIT)[other, part.gram]
        some = sizes[0, 1 - (part.texts & 1), 0] > 0
        return pa.table({"key": part.texts[some], "log": np.bincount(part.text, log, len(part.texts)).astype(np.int64)[some]})

    at = spark.createDataFrame(places.rows(), "lang string, a long, start int, parts int")
    sent = pairs.join(F.broadcast(at), ["lang", "a"]).select("lang", F.explode(F.expr("sequence(start, start + parts - 1)")).alias("part"), "half", F.col("b").alias("word"), "n")
    turn_of = F.pmod(F.col("part") + F.crc32(F.col("lang").cast("binary")), F.lit(rounds))
    scored = []
    with shuffles_dropped(spark):
        for turn in range(rounds):
            logs = by_part(turn).cogroup(sent.filter(turn_of == turn).groupBy("lang", "part")).applyInArrow(score, "key long, log long")
            scored.append(materialize(logs.groupBy("key").agg(F.sum("log").alias("log")), "word-scores"))
    return reduce(DataFrame.unionByName, scored).groupBy(F.col("key").bitwiseAND(-2).alias("key")).agg((F.sum("log") / UNIT).alias("log_probability"))
