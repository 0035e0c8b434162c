"""Secret scans: patterns, and character Markov models by log-likelihood ratio.

Base kinds are found by patterns, leftmost and non-overlapping within a kind, whole
texts, places in code points. Beside them, every run of 20 or more characters that
secrets are written in, less the base spans in it, is scored by two first-order character
Markov models, one of random strings and one of ordinary identifiers; runs whose mean
log-likelihood ratio a character reaches ``THRESHOLD``, and else the best-scoring parts of
20 or more characters that reach it, are added as ``markov``.

The models are trained on labelled samples from all rows: the values that base patterns
found are samples of random strings; runs of eight or more such characters that hold no such value
and stand in two or more different texts are samples of identifiers, as random strings
that no pattern labels seldom repeat. Each different sample counts once. Both models back off to the
frequencies of single characters, these smoothed by one, so that without samples
nothing is told apart.
Only the counts of character pairs, at most 68 * 68 a class, reach the driver; scoring
runs within the scan's rows, without joins or shuffles. All is built-in column
functions.

Defined cases: null texts are empty (no spans, the digest of the empty string); null and
repeated ids and repeated rows keep their rows; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from parcelog.llm.spans import MATCHES, let, matches, pieces, sums_before

#: Kinds in their order, with pattern, the group whose length counts, and its least length (fixed values).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: A run of hex digits shorter than this is never reported; the longest-run pattern finds the same runs.
HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = r"[A-Za-z0-9+/_.=-]"
#: Where no span of any kind reaches across: behind a character that is in none, behind a space away from : and =,
#: behind a colon without a name before it, behind a quotation mark within a word.
CUT = r"""[^A-Za-z0-9+/_.=\-"':\x20]|[^:=\x20]\x20(?=[^:=\x20])|[^\x20"':](?<!(?i:password|passwd|secret|token|key)):|[A-Za-z0-9+/_.-]["'](?=[A-Za-z0-9+/_.-])"""
LEAST_RUN, LEAST_SAMPLE = 20, 8
THRESHOLD = 0.9
#: Weight, in counts, of the single characters' frequencies behind each character's followers.
BACKOFF = 10.0
SPAN = "struct<start:int,kind:int,end:int>"
SPANS = f"array<{SPAN}>"
PLACES = "array<struct<start:int,end:int>>"
#: A part of a run ends where its sum of ratios has fallen so far (natural logarithms).
DROP = 8.0


def _long(values: Column, least: int) -> Column:
    return F.filter(values, lambda v: F.length(v) >= least)


def _of_kind(found: Column, kind: int, first: Column | None = None) -> Column:
    """Spans (start, kind, end) of matches, moved by ``first``."""
    at = F.lit(0) if first is None else first
    return F.transform(found, lambda m: F.struct((at + m["start"]).alias("start"), F.lit(kind).alias("kind"), (at + m["end"]).alias("end")))


def _assigned(text: Column) -> Column:
    """Spans of the first base kind in a piece of text."""
    _, pattern, group, least = BASE[0]
    found = F.filter(matches(text, pattern, group), lambda m: F.length(m["value"]) >= least)
    return F.when(text.rlike(pattern), _of_kind(found, 0)).otherwise(F.array().cast(SPANS))


def _at_least(found: Column, least: int) -> Column:
    """Matches of so many characters or more. (A second argument of the lambda would be the match's index.)"""
    return F.filter(found, lambda m: m["end"] - m["start"] >= least)


def _within(run: Column) -> Column:
    """Spans of the other base kinds, which lie within long runs."""
    kinds = [_at_least(matches(run["value"], HEX_RUN if name == "hex" else own), least) for name, own, _, least in BASE[1:]]
    return F.concat(*[_of_kind(found, k, run["start"]) for k, found in enumerate(kinds, 1)]).cast(SPANS)


def samples(docs: DataFrame) -> DataFrame:
    """Different labelled samples: ``value`` and ``secret`` (true for values that base patterns found)."""
    text = F.col("text")
    _, assign, group, least = BASE[0]

    def of_piece(piece: Column) -> Column:
        assigned = F.when(piece.rlike(assign), _long(F.regexp_extract_all(piece, F.lit(assign), F.lit(group)), max(least, LEAST_SAMPLE))).otherwise(F.array().cast("array<string>"))
        inner = lambda r: F.concat(*[_long(F.regexp_extract_all(r, F.lit(HEX_RUN if name == "hex" else own), F.lit(0)), n) for name, own, _, n in BASE[1:]])
        labelled = lambda runs: F.concat(assigned, F.flatten(F.transform(_long(runs, LEAST_RUN), inner)))
        own = lambda runs, secrets: F.when(F.size(secrets) > 0, F.filter(runs, lambda r: ~F.exists(secrets, lambda s: F.contains(r, s)))).otherwise(runs)
        all_runs = F.regexp_extract_all(piece, F.lit(f"{RUN}{{{LEAST_SAMPLE},}}+"), F.lit(0))
        return let(all_runs, lambda runs: let(labelled(runs), lambda secrets: F.struct(secrets.alias("secrets"), own(runs, secrets).alias("runs"))))

    found = docs.filter(text.isNotNull()).select(F.xxhash64("text").alias("of"), F.transform(pieces(text, CUT), of_piece).alias("found"))
    named = lambda part, secret: F.transform(F.array_distinct(F.flatten(F.col(f"found.{part}"))), lambda v: F.struct(v.alias("value"), F.lit(secret).alias("secret")))
    rows = found.select("of", F.inline(F.concat(named("secrets", True), named("runs", False))))
    # One shuffle by value; an identifier stands in two texts at least: the first and last text differ.
    counted = rows.groupBy("value").agg(F.max("secret").alias("secret"), F.min("of").alias("first"), F.max("of").alias("last"))
    return counted.filter("secret or first < last").select("value", "secret")


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, in the order of the alphabet, from samples (value, secret)."""
    n = len(ALPHABET)
    chars = labelled.select("secret", F.filter(F.split("value", ""), lambda c: c != "").alias("c")).filter(F.size("c") > 1)
    pairs = chars.select("secret", F.explode(F.zip_with(F.expr("slice(c, 1, size(c) - 1)"), F.expr("slice(c, 2, size(c) - 1)"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    counted = pairs.groupBy("secret", "p").agg(F.count("*").alias("n")).select("secret", F.expr(f"instr('{ALPHABET}', p.a) - 1").alias("a"), F.expr(f"instr('{ALPHABET}', p.b) - 1").alias("b"), "n")
    counts = {True: [[0] * n for _ in range(n)], False: [[0] * n for _ in range(n)]}
    for r in counted.filter("a >= 0 and b >= 0").collect():  # 2 * 68 * 68 rows at most
        counts[r["secret"]][r["a"]][r["b"]] += r["n"]

    def logs(table: list[list[int]]) -> list[float]:
        total = sum(map(sum, table)) + n
        single = [(sum(column) + 1) / total for column in zip(*table, strict=True)]
        return [math.log((row[b] + BACKOFF * single[b]) / (sum(row) + BACKOFF)) for row in table for b in range(n)]

    return [a - b for a, b in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def _outside(run: Column, base: Column) -> Column:
    """(start, end, value) of what base spans leave of a run, where that is long enough."""
    touching = F.array_sort(F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])))
    nothing = F.array().cast(MATCHES)

    def piece(start: Column, end: Column) -> Column:
        value = F.substring(run["value"], start - run["start"] + 1, end - start)
        return F.when(end - start >= LEAST_RUN, F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))).otherwise(nothing)

    step = lambda s, b: F.struct(F.greatest(s["at"], b["end"]).alias("at"), F.concat(s["out"], piece(s["at"], b["start"])).alias("out"))
    cut = F.aggregate(touching, F.struct(run["start"].alias("at"), nothing.alias("out")), step, lambda s: F.concat(s["out"], piece(s["at"], run["end"])))
    return F.when(F.size(touching) > 0, cut).otherwise(F.array(run))


def _random(run: Column, weights: Column, threshold: float) -> Column:
    """(start, end) of the random parts of a run: the whole if its mean ratio a pair suffices, else its best-scoring parts.

    Parts are those of the greatest sum of ratios less half the threshold; a part ends for good
    where the sum is used up or falls ``DROP`` below its greatest.
    """
    n, shift = len(ALPHABET), max(threshold, 0.0) / 2
    codes = F.transform(F.filter(F.split(run["value"], ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    nothing = F.array().cast(PLACES)

    def state(last: Column, at: Column, total: Column, start: Column, sum_: Column, best: Column, end: Column, out: Column) -> Column:
        return F.struct(last.alias("last"), at.alias("at"), total.alias("total"), start.alias("start"), sum_.alias("sum"), best.alias("best"), end.alias("end"), out.alias("out"))

    def with_best(s: Column) -> Column:
        pairs = s["end"] - s["start"] - 1
        enough = (pairs + 1 >= LEAST_RUN) & (s["best"] + shift * pairs >= threshold * pairs)
        return F.when(enough, F.concat(s["out"], F.array(F.struct((run["start"] + s["start"]).alias("start"), (run["start"] + s["end"]).alias("end"))))).otherwise(s["out"])

    def step(s: Column, c: Column) -> Column:
        weight = F.when(s["last"] < 0, F.lit(0.0)).otherwise(F.element_at(weights, s["last"] * n + c + 1))
        now = s["sum"] + weight - shift
        total, after = s["total"] + weight, s["at"] + 1
        over, better = (now <= 0) | (s["best"] - now > DROP), now > s["best"]
        ended = state(c, after, total, s["at"], F.lit(0.0), F.lit(0.0), after, with_best(s))
        longer = state(c, after, total, s["start"], now, now, after, s["out"])
        same = state(c, after, total, s["start"], now, s["best"], s["end"], s["out"])
        return F.when(over, ended).when(better, longer).otherwise(same)

    zero, nil = F.lit(0), F.lit(0.0)
    whole = F.array(F.struct(run["start"].alias("start"), run["end"].alias("end")))
    return F.aggregate(codes, state(F.lit(-1), zero, nil, zero, nil, nil, zero, nothing), step, lambda s: F.when(s["total"] >= threshold * (s["at"] - 1), whole).otherwise(with_best(s)))


def _spans(text: Column, weights: Column, threshold: float) -> Column:
    """Spans of a piece of text by start and kind, places within the piece."""

    def in_run(run: Column, assigned: Column) -> Column:
        def all_kinds(own: Column) -> Column:
            random = F.flatten(F.transform(_outside(run, F.concat(own, assigned)), lambda m: _random(m, weights, threshold)))
            return F.concat(own, _of_kind(random, len(BASE)).cast(SPANS))

        return let(_within(run), all_kinds)

    def with_runs(runs: Column, assigned: Column) -> Column:
        return F.when(F.size(runs) > 0, F.array_sort(F.concat(assigned, F.flatten(F.transform(runs, lambda r: in_run(r, assigned)))))).otherwise(assigned)

    return let(matches(text, f"{RUN}{{{LEAST_RUN},}}+"), lambda runs: let(_assigned(text), lambda assigned: with_runs(runs, assigned)))


def in_pieces(docs: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secret_pieces``: the text's pieces as (text, start, spans), places of spans within the piece."""
    weights = F.split(F.lit(",".join(f"{x:.5f}" for x in model)), ",").cast("array<double>")  # folded to one literal
    cut = pieces(F.coalesce("text", F.lit("")), CUT)
    placed = let(cut, lambda own: F.zip_with(own, sums_before(F.transform(own, F.length)), lambda t, at: F.struct(t.alias("text"), at.alias("start"), _spans(t, weights, threshold).cast(SPANS).alias("spans"))))
    return docs.withColumn("secret_pieces", placed)


def spans(docs: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secret_spans``: (start, kind, end) of all spans by start and kind, kinds numbered as in ``KINDS``."""
    moved = lambda p: F.transform(p["spans"], lambda s: F.struct((p["start"] + s["start"]).alias("start"), s["kind"].alias("kind"), (p["start"] + s["end"]).alias("end")))
    return in_pieces(docs, model, threshold).withColumn("secret_spans", F.flatten(F.transform("secret_pieces", moved))).drop("secret_pieces")


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, digest and list of the spans of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spans(own, train(samples(own)), threshold)
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secret_spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *[count(k).alias(f"n_{BASE[k][0]}") for k in range(len(BASE))], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"))


def _masked(piece: Column, mask: str) -> Column:
    """The text of a piece with its spans, overlapping ones as one, replaced."""
    text = piece["text"]

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(s["out"], gap, F.lit(mask))).alias("out"))

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(piece["spans"]) > 0, F.aggregate(piece["spans"], F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)).otherwise(text)


def redact(docs: DataFrame, mask: str = "[secret]", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with every span, overlapping ones as one, replaced by ``mask``; ``n_chars``, where there is one, counts anew.

    The name that the scan needs (``secret_pieces``) gives way where ``docs`` has it.
    """
    own = {c: f"{c}_own" for c in docs.columns if c.lower() == "secret_pieces"}
    found = in_pieces(docs.withColumnsRenamed(own), train(samples(docs)), threshold)
    changed = F.exists("secret_pieces", lambda p: F.size(p["spans"]) > 0)
    new = {"text": F.when(changed, F.array_join(F.transform("secret_pieces", lambda p: _masked(p, mask)), "")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        sizes = F.aggregate("secret_pieces", F.lit(0).cast("long"), lambda n, p: n + F.length(_masked(p, mask)))
        new["n_chars"] = F.when(changed, sizes.cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns(new).drop("secret_pieces").withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
