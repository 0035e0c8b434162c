"""Quality rules: counts of whole texts, and n-gram perplexity bands by language.

With ``words`` the n-grams are trigrams of words (``word_model``, which op3 uses): texts that fail the base
rules have no perplexity then, and those that no other texts can measure are kept. What follows
on symbols is the model without it; bounds are found alike.

The model of symbols is a modified Kneser-Ney model of the third order over characters, folded to
``SYMBOLS`` symbols, one for each language. Symbols are white space, digits, the letters a
to z, capitals (vowels and others), marks, and ``OTHER_LETTERS`` classes of letters beyond
ASCII, dealt by lower-case code point: letters of alphabets with neighbouring code points
(Cyrillic, Greek, Arabic, Hebrew, accented Latin) have classes of their own, those of large
scripts share them. That bounds a language's n-grams by ``SYMBOLS ** 3`` whatever its script.

Tasks count trigrams of all texts that pass the base rules and Spark sums them; of each
language at most ``SYMBOLS ** 3`` rows come together, where discounts, probabilities and
backoff weights are worked out and stored in the shared folder as hashes in ascending order
with their values. Tasks load the arrays of the languages that they meet and look up the
n-grams of their texts in them, from the trigram back to the single symbol. Texts that a
language holds more than once count once, in the model as in the bounds below, so that a
group of copies of any size weighs as much as one document.

A language's documents of like length (powers of two) give a lower and an upper bound:
the median of the logarithm of their perplexities less and plus ``width`` times the
median deviation (at least ``least_deviation``). Bounds come from all different texts that
pass the base rules, by way of a histogram in steps of ``STEP``. A class's bounds are drawn to those of its language,
and a language's to those of all documents, with the weight of ``prior_docs`` documents, at
every size alike.

Defined cases: a null text has no words and fails the base rules; a null language is the
language of the empty name; a language whose texts are all empty or fail the base rules has
no model, and its documents are not kept; null and repeated ids and repeated rows keep their
rows; an empty table gives no rows; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import hashlib
import unicodedata
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelog.llm import word_model
from parcelog.llm.frames import open_uri
from parcelog.storage import materialize, scratch_path, small_batches

SYMBOLS, OTHER_LETTERS = 96, 48
WIDTH, LEAST_DEVIATION, STEP, PRIOR_DOCS = 5.0, 0.02, 0.01, 50
#: Base limits: fewest words, and most words of each hundred in repeated windows of WINDOW words.
LEAST_WORDS, MOST_REPEATED, REPEAT_WINDOW = 10, 20, 5
#: Languages whose arrays a worker keeps (11 MB each at most).
KEPT_LANGUAGES = 8
STATS = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, log_probability double, digest binary"
WORD_STATS = "doc_id long, lang string, digest long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _symbol(c: int) -> int:
    """0 white space, 1 digit, 2-27 a-z, 28 and 29 capitals, 30-45 single marks, 46-93 other letters, 94 other marks, 95 the rest."""
    ch = chr(c)
    if ch.isspace():
        return 0
    if c < 128:
        if ch.isdigit():
            return 1
        if ch.isalpha():
            return 2 + c - 97 if c >= 97 else 28 if ch in "AEIOU" else 29
        at = ".,;:!?'\"-()#*|$%".find(ch)
        return 30 + at if at >= 0 else 94
    kind = unicodedata.category(ch)
    return 46 + ord(ch.lower()[0]) % OTHER_LETTERS if kind[0] in "LM" else 1 if kind == "Nd" else 94 if kind[0] in "PS" else 95


SYMBOL = np.array([_symbol(c) if not 0xD800 <= c < 0xE000 else 95 for c in range(1 << 16)], dtype=np.uint8)


def trigrams(text: str) -> np.ndarray:
    """Trigrams of a text's symbols behind two spaces; runs of white space count as one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.where(points < 1 << 16, SYMBOL[np.minimum(points, 0xFFFF)], 95).astype(np.int32)
    s = np.concatenate([np.zeros(2, np.int32), s[(s > 0) | np.concatenate([[False], s[:-1] > 0])]]) if len(s) else np.zeros(2, np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def count_trigrams(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all different texts of each language that pass the base rules."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, table in tables.items():
                gram = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int32)), pa.array(table[gram])], names=["lang", "gram", "n"])
            tables.clear()

        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.encode().split()
                if not base_fails(len(words), repeated_words(words)):
                    texts.setdefault(lang, []).append(trigrams(text))
            for lang, own in texts.items():
                if lang not in tables:
                    if len(tables) == KEPT_LANGUAGES:
                        yield from emptied()
                    tables[lang] = np.zeros(SYMBOLS**3, np.int64)
                tables[lang] += np.bincount(np.concatenate(own), minlength=SYMBOLS**3)
        yield from emptied()

    different = docs.filter("text is not null").select("text", F.coalesce("lang", F.lit("")).alias("lang")).distinct()
    counted = different.mapInArrow(count, "lang string, gram int, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


#: What a hash stands for: probabilities of single symbols, pairs and trigrams, and weights behind pairs and single symbols.
ONE, TWO, THREE, BEHIND_TWO, BEHIND_ONE = range(5)


def _mixed(kind: int, gram: np.ndarray) -> np.ndarray:
    """64-bit hash of an n-gram; one to one, as multiplication by an odd number and shifts are."""
    h = (gram.astype(np.uint64) | np.uint64(kind << 32)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more."""
    return word_model.discounts(*(int((counts == k).sum()) for k in (1, 2, 3, 4)))


def _level(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending n-grams with their counts: what discounting leaves of each one's share, the contexts, and their weights."""
    taken = _discounts(n)[np.minimum(n, 3)]
    context, first = np.unique(gram // SYMBOLS, return_index=True)
    total = np.add.reduceat(n, first)
    of = np.repeat(np.arange(len(context)), np.diff(np.append(first, len(gram))))
    return (n - taken) / total[of], context, np.add.reduceat(taken, first) / total


def estimate(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and values (natural logarithms) of n-grams seen and of the weights behind contexts seen."""
    order = np.argsort(gram)
    gram, n = gram[order].astype(np.int64), n[order].astype(np.int64)
    pair, n_pair = np.unique(gram % SYMBOLS**2, return_counts=True)  # different symbols before: continuation counts
    single, n_single = np.unique(pair % SYMBOLS, return_counts=True)
    p1 = np.full(SYMBOLS, 1 / SYMBOLS)
    share, _, weight = _level(single, n_single)
    p1 = p1 * weight[0]
    p1[single] += share
    share2, context2, weight2 = _level(pair, n_pair)
    p2 = share2 + weight2[np.searchsorted(context2, pair // SYMBOLS)] * p1[pair % SYMBOLS]
    share3, context3, weight3 = _level(gram, n)
    p3 = share3 + weight3[np.searchsorted(context3, gram // SYMBOLS)] * p2[np.searchsorted(pair, gram % SYMBOLS**2)]
    parts = ((ONE, np.arange(SYMBOLS), p1), (TWO, pair, p2), (THREE, gram, p3), (BEHIND_ONE, context2, weight2), (BEHIND_TWO, context3, weight3))
    keys = np.concatenate([_mixed(kind, own) for kind, own, _ in parts])
    values = np.log(np.maximum(np.concatenate([v for *_, v in parts]), 1e-30)).astype("<f4")
    order = np.argsort(keys)
    return keys[order], values[order]


def look_up(keys: np.ndarray, values: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Logarithm of each trigram's probability: its own if seen, else the context's weight times that of the shorter n-gram."""

    def find(kind: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = _mixed(kind, own)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        seen = keys[at] == h
        return np.where(seen, values[at], 0.0), seen  # no weight is taken behind a context never seen

    out, seen = find(THREE, gram)
    left = np.flatnonzero(~seen)
    if len(left):
        pair = gram[left] % SYMBOLS**2
        shorter, seen = find(TWO, pair)
        one = np.flatnonzero(~seen)
        shorter[one] = find(BEHIND_ONE, pair[one] // SYMBOLS)[0] + find(ONE, pair[one] % SYMBOLS)[0]
        out[left] = find(BEHIND_TWO, gram[left] // SYMBOLS)[0] + shorter
    return out


def dense(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``look_up`` for every trigram."""
    return look_up(keys, values, np.arange(SYMBOLS**3))


def write_model(path: str, keys: np.ndarray, values: np.ndarray) -> None:
    fs, name = open_uri(path)
    with fs.open_output_stream(name, compression=None) as sink:
        sink.write(np.array([len(keys)], "<u8").tobytes() + keys.astype("<u8").tobytes() + values.astype("<f4").tobytes())


def read_model(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and their values; 11 MB at most."""
    fs, name = open_uri(path)
    with fs.open_input_file(name) as source:
        data = source.read()
    n = int(np.frombuffer(data, "<u8", 1)[0])
    return np.frombuffer(data, "<u8", n, 8), np.frombuffer(data, "<f4", n, 8 + 8 * n)


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def train(docs: DataFrame) -> DataFrame:
    """lang and path: a model file for each language below the shared folder."""
    directory = scratch_path(docs.sparkSession, "models")

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fs, folder = open_uri(directory)
        fs.create_dir(folder, recursive=True)
        path = f"{directory}/{uuid.uuid4().hex}.model"  # a retried task writes another file
        write_model(path, *estimate(rows["gram"].to_numpy(), rows["n"].to_numpy()))
        return pd.DataFrame({"lang": [key[0]], "path": [path]})

    counted = materialize(count_trigrams(docs), "trigrams")
    return materialize(counted.groupBy("lang").applyInPandas(fit, "lang string, path string"), "model-paths")


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words within windows that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    key, values = ids[:n], len(number)
    for k in range(1, window):
        if values >= (1 << 62) // len(number):
            key = np.unique(key, return_inverse=True)[1]
            values = n
        key = key * len(number) + ids[k : k + n]
        values *= len(number)
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    hit = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key)
    cover = np.bincount(hit, minlength=len(words) + 1) - np.bincount(hit + window, minlength=len(words) + 1)
    return int((np.cumsum(cover[: len(words)]) > 0).sum())


def character_counts(text: str | None) -> tuple[int, int, int]:
    """Code points in words, symbols, and repeated lines with a word."""
    text = text or ""
    data = text.encode()
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    blanks = len(data) - len(data.translate(None, b" \t\n\x0b\x0c\r"))
    return len(text) - blanks, symbols, len(lines) - len(set(lines))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, ``character_counts``, and words in repeated windows."""
    words = (text or "").encode().split()
    return len(words), *character_counts(text), repeated_words(words)


def statistics(docs: DataFrame, models: DataFrame) -> DataFrame:
    """Base counts of every document, its trigrams, the logarithm of their probability, and the text's digest."""
    small_batches(docs.sparkSession)
    paths = {r["lang"]: r["path"] for r in models.collect()}  # a path for each language; tasks load those they meet

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: OrderedDict[str, tuple[np.ndarray, np.ndarray]] = OrderedDict()

        def model(lang: str) -> tuple[np.ndarray, np.ndarray]:
            if lang not in models:
                models[lang] = read_model(paths[lang])
                if len(models) > KEPT_LANGUAGES:
                    models.popitem(last=False)
            return models[lang]

        for batch in batches:
            ids, texts, langs = (batch.column(k).to_pylist() for k in range(3))
            grams: dict[str, list[np.ndarray]] = {}
            places: dict[str, list[int]] = {}
            for i, (text, lang) in enumerate(zip(texts, langs, strict=True)):
                if text is not None and lang in paths:
                    grams.setdefault(lang, []).append(trigrams(text))
                    places.setdefault(lang, []).append(i)
            n, log = [0] * len(ids), [0.0] * len(ids)
            known = np.empty(SYMBOLS**3, np.float64)  # filled only where this batch has n-grams
            for lang, own in grams.items():
                met = np.zeros(SYMBOLS**3, bool)
                for g in own:
                    met[g] = True
                kinds = np.flatnonzero(met)
                known[kinds] = look_up(*model(lang), kinds)
                for i, g in zip(places[lang], own, strict=True):
                    n[i], log[i] = len(g), float(known[g].sum())
            digests = [None if t is None else hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts]
            columns = [ids, langs, *(list(c) for c in zip(*map(base_counts, texts), strict=True)), n, log, digests] if ids else [()] * 10
            kinds_ = [pa.int64(), pa.string(), *[pa.int64()] * 6, pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_, strict=True)], names=[x.split()[0] for x in STATS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang")).mapInArrow(measure, STATS)


def bands(scored: DataFrame, width: float = WIDTH, least_deviation: float = LEAST_DEVIATION) -> DataFrame:
    """lang, size, low, high from the columns lang, size and log_perplexity; null stands for all."""
    step = F.round(F.col("log_perplexity") / STEP).cast("int").alias("x")
    counts = scored.groupBy("lang", "size", step).agg(F.count("*").alias("n"))  # bounded: steps, lengths, languages
    every = counts.union(counts.select("lang", F.lit(None).cast("int"), "x", "n")).union(counts.select(F.lit(None).cast("string"), F.lit(None).cast("int"), "x", "n"))
    every = every.groupBy("lang", "size", "x").agg(F.sum("n").alias("n"))

    def middle(df: DataFrame, x: str, name: str) -> DataFrame:
        own = Window.partitionBy("lang", "size")
        upto = F.sum("n").over(own.orderBy(x))
        return df.withColumns({"upto": upto, "all": F.sum("n").over(own)}).filter("2 * upto >= all").groupBy("lang", "size").agg(F.min(x).alias(name), F.first("all").alias("docs"))

    renamed = lambda df: df.withColumnsRenamed({"lang": "lang_", "size": "size_"})
    same = F.col("lang").eqNullSafe(F.col("lang_")) & F.col("size").eqNullSafe(F.col("size_"))
    middles = middle(every, "x", "median")
    off = every.join(renamed(middles), same).select("lang", "size", F.abs(F.col("x") - F.col("median")).alias("off"), "n")
    deviation = middle(off.groupBy("lang", "size", "off").agg(F.sum("n").alias("n")), "off", "deviation").drop("docs")
    half = F.greatest(F.col("deviation") * STEP, F.lit(least_deviation)) * width
    return middles.join(renamed(deviation), same).select("lang", "size", (F.col("median") * STEP - half).alias("low"), (F.col("median") * STEP + half).alias("high"), "docs")


def _blended(own: str, n: str, general: Column, prior: float) -> Column:
    """A bound drawn to the general one with the weight of ``prior`` documents."""
    return F.when(F.col(own).isNull(), general).otherwise((F.col(n) * F.col(own) + prior * F.coalesce(general, F.col(own))) / (F.col(n) + prior))


def word_statistics(docs: DataFrame, ranks: word_model.Numbers) -> DataFrame:
    """Base counts of every document and the text's key; besides, rows that bear a language's name and a block of its texts that pass the base rules."""
    small_batches(docs.sparkSession)
    names, kinds = zip(*(x.split() for x in f"{WORD_STATS}, data binary".split(", ")), strict=True)
    schema = pa.schema([(name, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind]) for name, kind in zip(names, kinds, strict=True)])
    passes = lambda n, repeat: (n >= LEAST_WORDS) & (100 * repeat <= MOST_REPEATED * n)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_model.Coder(ranks, passes, REPEAT_WINDOW)

        def measured(gathered: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(gathered).combine_chunks()
            places: dict[str, list[int]] = {}
            for i, lang in enumerate(table["lang"].to_pylist()):
                places.setdefault(lang, []).append(i)
            n_words, data = np.zeros((2, table.num_rows), np.int64), []
            for lang, rows in places.items():
                own = table.take(pa.array(rows))
                texts = pc.fill_null(own["text"].combine_chunks(), "")
                texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
                n_words[0, rows], n_words[1, rows], block = coder.block(lang, np.asarray(own["digest"]), texts)
                if block is not None:
                    data.append((lang, block))
            rest = [character_counts(t) for t in table["text"].to_pylist()]
            columns = [table[c].combine_chunks() for c in names[:3]] + [n_words[0], *(np.array(c, np.int64) for c in zip(*rest, strict=True)), n_words[1], pa.nulls(len(rest), pa.binary())]
            yield from pa.table(columns, schema=schema).to_batches()
            if data:
                lang, block = zip(*data, strict=True)
                own = {"lang": pa.array(lang), "data": pa.array(block, pa.binary())}
                yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(len(data), f.type)) for f in schema], schema=schema)

        gathered, size = [], 0
        for batch in batches:
            gathered.append(batch)
            size += batch.nbytes
            if size >= word_model.BLOCK_BYTES:
                yield from measured(gathered)
                gathered, size = [], 0
        if sum(b.num_rows for b in gathered):
            yield from measured(gathered)

    return docs.mapInArrow(measure, f"{WORD_STATS}, data binary")


def _with_words(docs: DataFrame, shown: int = word_model.SHOWN, **cut: int) -> DataFrame:
    """Counts and the logarithm of the probability of every document that passes the base rules, by trigrams of words."""
    lang = F.coalesce("lang", F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.xxhash64(lang, "text").bitwiseAND(-2).alias("digest"), "text")
    frequent = word_model.frequent_words(keyed.filter("text is not null").select(F.col("digest").alias("key"), "lang", "text"), shown)
    read = materialize(word_statistics(keyed, word_model.Numbers(frequent)), "statistics")
    stats, coded = read.filter("data is null").drop("data"), read.filter("data is not null").select("lang", "data")
    sizes = stats.filter(~_base_failed()).groupBy("lang").agg(F.sum(F.col("n_words") + 1).alias("n")).collect()  # a row for each language
    if not sizes:
        return stats.withColumns({"n_grams": F.lit(0).cast("long"), "log_probability": F.lit(0.0)})
    found = word_model.log_probability(coded, frequent, {r["lang"]: r["n"] for r in sizes}, shown=shown, **cut).withColumnRenamed("key", "digest")
    known = F.when(~_base_failed() & F.col("log_probability").isNotNull(), F.col("n_words") + 1).otherwise(0)
    return materialize(stats.join(found, "digest", "left").withColumn("n_grams", known), "word-statistics")


def rules(docs: DataFrame, width: float = WIDTH, least_deviation: float = LEAST_DEVIATION, prior_docs: float = PRIOR_DOCS, words: bool = False, **cut: int) -> DataFrame:
    """Counts, base rule, perplexity and verdict of every document, by trigrams of symbols or of words; ``cut`` goes to the model of words."""
    stats = _with_words(docs, **cut) if words else materialize(statistics(docs, train(docs)), "statistics")
    scored = stats.withColumns({
        "base_failed": _base_failed(),
        "log_perplexity": F.when(F.col("n_grams") > 0, -F.col("log_probability") / F.col("n_grams")),
        "size": F.floor(F.log2(F.greatest("n_grams", F.lit(1)))).cast("int"),
    })
    different = scored.filter("not base_failed and log_perplexity is not null").select("lang", "size", "log_perplexity", "digest").distinct()  # copies count once
    found = bands(different, width, least_deviation)
    of_all = F.max(F.when(F.col("lang").isNull(), F.struct("low", "high"))).over(Window.partitionBy(F.lit(1)))  # a row for each language and power of two
    found = found.withColumn("of_all", of_all).filter("lang is not null")
    sized = found.filter("size is not null").select("lang", "size", "low", "high", "docs")
    general = found.filter("size is null").select("lang", *[_blended(c, "docs", F.col(f"of_all.{c}"), prior_docs).alias(f"lang_{c}") for c in ("low", "high")])
    joined = scored.join(F.broadcast(sized), ["lang", "size"], "left").join(F.broadcast(general), "lang", "left")
    low, high = (_blended(c, "docs", F.col(f"lang_{c}"), prior_docs) for c in ("low", "high"))
    within = F.coalesce(F.col("log_perplexity").between(low, high), F.lit(words))  # by words, texts that no others can measure stay
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & within).alias("kept"), F.exp("log_perplexity").alias("perplexity"), "lang")
