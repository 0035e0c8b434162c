"""Benchmark decontamination by the q-gram lemma in diagonal bands.

Texts and benchmark items are normalised (lower case; runs of anything but letters and
digits become one space). An item of m bytes may appear with at most e = ``budget`` * m
edits, and then shares at least m - q + 1 - q * e of its q-grams with the place, on
diagonals that e edits can shift by e at most. Every q-gram of a document is looked up
in the sorted q-grams of the items; hits are counted, each place of the item once, in
bands of diagonals 2e + 2 wide that overlap by half, so that some band holds the whole
region. Regions that reach the bound are verified by alignment within the band (edit
distance of the item against any part of the region, bit-parallel).

One rule holds at every length: a document leaks an item that it holds within the item's
own budget (``whole`` is true), or of which it holds a part of ``window`` bytes within that
part's budget (``whole`` is false; edits and places are then the part's). Parts begin at
each half window and end at the item's end; ``window=None`` seeks whole items only. q is
the greatest of ``QS`` that gives a bound of one or more. Items so short that the budget
allows no edit (under 13 bytes at 8 %) are found as whole runs of words: inside other
words they would say nothing. That length is a parameter, ``whole_words_below``.

Items are dealt into blocks of bounded size (``block_bytes``); ``BLOCKS_A_PASS`` blocks are
one pass over the documents, after which a table is written, so a task holds the tables of
these blocks only. That suits benchmarks of megabytes, not ones as large as the corpus.
Work on one text is bounded, too: hits are expanded ``MOST_HITS`` at a time, and regions of
one pattern that overlap are verified together, many patterns at once.

Defined cases: null and empty texts and items match nothing; items equal after
normalising are each reported; repeated documents are each reported; an empty table on
either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelog.storage import materialize, small_batches

#: Lengths of q-grams, the longest that a pattern's bound allows first.
QS = (8, 4, 2)
BUDGET = 0.08
WINDOW = 240
#: Items shorter than this, in normalised bytes, are found as whole words only: within words they would be found by chance.
WHOLE_WORDS_BELOW = 13
#: Normalised bytes of items in a block; the block's table takes about forty times that in a task.
BLOCK_BYTES = 1 << 20
BLOCKS_A_PASS = 4
#: Hits expanded at once (about 100 bytes each).
MOST_HITS = 2_000_000
HITS = "array<struct<item_id:long,edits:int,start:int,end:int,whole:boolean>>"

_JUNK = re.compile(r"[\W_]+")


def normalise(text: str | None) -> bytes:
    """Lower-case words of letters and digits, one space apart."""
    return _JUNK.sub(" ", (text or "").lower()).strip().encode()


def grams(data: np.ndarray, q: int = 8) -> np.ndarray:
    """Every run of q bytes (2, 4 or 8) as one 64-bit value."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    out = data[:-1].astype(np.uint16) | data[1:].astype(np.uint16) << np.uint16(8)
    for have, kind in ((2, np.uint32), (4, np.uint64)):
        if have < q:
            out = out[:-have].astype(kind) | out[have:].astype(kind) << kind(8 * have)
    return out.astype(np.uint64)


def fewest(pattern: bytes, place: bytes, anchored: bool = False) -> tuple[int, int]:
    """(edits, end) of the part of ``place`` nearest to ``pattern`` that ends first; an anchored part begins at 0.

    A column of the table of edit distances is two integers: the rows where it rises and those where it falls.
    """
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << m >> 1
    rows = dict.fromkeys(pattern, 0)
    for i, c in enumerate(pattern):
        rows[c] |= 1 << i
    rise, fall, edits, best, end = mask, 0, m, m, 0
    for j, c in enumerate(place, 1):
        same = rows.get(c, 0)
        level = (((same & rise) + rise) ^ rise | same) & mask
        up, down = fall | (level | rise) ^ mask, rise & level
        if up & top:
            edits += 1
        elif down & top:
            edits -= 1
            if edits < best:
                best, end = edits, j
        up, down, same = (up << 1 | anchored) & mask, down << 1 & mask, same | fall
        rise, fall = down | (same | up) ^ mask, up & same
    return best, end


def align(item: bytes, place: bytes, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best match of ``item`` in ``place`` if at most ``most`` edits; columns free at both ends."""
    edits, end = fewest(item, place)
    if edits > most:
        return None
    return edits, end - fewest(item[::-1], place[:end][::-1], anchored=True)[1], end


def fewest_of_many(patterns: list[bytes], places: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """What ``fewest`` gives for each pair, all at once: 64 rows to a word, a pair to a lane."""
    n, words = len(patterns), (max(map(len, patterns)) + 63) // 64
    unique = list(dict.fromkeys(patterns))
    rows = np.zeros((256, words, len(unique)), np.uint64)
    for u, p in enumerate(unique):
        at = np.arange(len(p))
        np.bitwise_or.at(rows, (np.frombuffer(p, np.uint8), at // 64, u), np.uint64(1) << (at % 64).astype(np.uint64))
    number = {p: u for u, p in enumerate(unique)}
    lane = np.array([number[p] for p in patterns])
    size = np.array([len(p) for p in patterns])
    columns = np.zeros((max(map(len, places)), n), np.uint8)  # zero is in no normalised text, and nothing gets better by it
    for i, p in enumerate(places):
        columns[: len(p), i] = np.frombuffer(p, np.uint8)
    one, last = np.uint64(1), np.uint64(63)
    word, bit, lanes = (size - 1) // 64, ((size - 1) % 64).astype(np.uint64), np.arange(n)
    rise, fall = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    edits, best, end = size.copy(), size.copy(), np.zeros(n, np.int64)
    level, carry = np.empty_like(rise), np.empty(n, np.uint64)
    for j, c in enumerate(columns, 1):
        same = rows[c, :, lane].T
        both = same & rise
        carry[:] = 0
        for w in range(words):
            total = both[w] + rise[w]
            level[w] = total + carry
            carry = ((total < both[w]) | (level[w] < total)).astype(np.uint64)
        level ^= rise
        level |= same
        up, down = fall | ~(level | rise), rise & level
        edits += (up[word, lanes] >> bit & one).astype(np.int64) - (down[word, lanes] >> bit & one).astype(np.int64)
        better = edits < best
        best[better], end[better] = edits[better], j
        same |= fall
        up[1:], down[1:], up[0], down[0] = up[1:] << one | up[:-1] >> last, down[1:] << one | down[:-1] >> last, up[0] << one, down[0] << one
        rise, fall = down | ~(same | up), up & same
    return best, end


def _merged(k: np.ndarray, a: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions (pattern, start, end), those of one pattern that overlap as one."""
    if not len(k):
        return k, a, z
    order = np.lexsort((a, k))
    k, a, z = k[order], a[order], z[order]
    far = int(z.max(initial=0)) + 1
    reached = np.maximum.accumulate(z + k * far) - k * far  # greatest end so far of the pattern
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (a[1:] > reached[:-1])]))
    return k[new], a[new], np.maximum.reduceat(z, new)


class Index:
    """The q-grams of some patterns in sorted arrays, with a bit table in front."""

    def __init__(self, patterns: list[bytes], most: list[int], q: int) -> None:
        self.patterns, self.q = patterns, q
        self.size, self.most = np.array([len(p) for p in patterns]), np.array(most)
        self.bound = self.size - q + 1 - q * self.most
        values = [grams(np.frombuffer(p, np.uint8), q) for p in patterns]
        value = np.concatenate(values)
        order = np.argsort(value, kind="stable")
        self.value = value[order]
        self.pattern = np.repeat(np.arange(len(values)), [len(v) for v in values])[order]
        self.place = np.concatenate([np.arange(len(v)) for v in values])[order]
        self.bits = max(16, int(len(value) * 16).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.slot(self.value)] = True
        self._by_size: list[tuple[np.ndarray, Index]] | None = None

    def slot(self, value: np.ndarray) -> np.ndarray:
        return (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def by_size(self) -> list[tuple[np.ndarray, Index]]:
        """Indexes of patterns of like length (powers of two), with the patterns' numbers here."""
        if self._by_size is None:
            power = np.log2(self.size).astype(int)
            groups = [np.flatnonzero(power == p) for p in np.unique(power)]
            self._by_size = [(g, Index([self.patterns[i] for i in g], self.most[g].tolist(), self.q)) for g in groups] if len(groups) > 1 else [(groups[0], self)]
        return self._by_size

    def regions(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, start, end) of the regions of a text that reach the lemma's bound."""
        value = grams(text, self.q)
        at = np.flatnonzero(self.table[self.slot(value)])
        value = value[at]
        first = np.searchsorted(self.value, value, "left")
        n = np.searchsorted(self.value, value, "right") - first
        at, value, first, n = at[n > 0], value[n > 0], first[n > 0], n[n > 0]
        nothing = (np.zeros(0, np.int64),) * 3
        if not len(at):
            return nothing
        if n.sum() > MOST_HITS and len(self.by_size()) > 1:
            found = [(own[k], a, z) for own, index in self.by_size() for k, a, z in (index.regions(text),)]
            return tuple(np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(value, kind="stable")
        again = np.flatnonzero(value[order[1:]] == value[order[:-1]])
        before = np.full(len(at), -1)  # the last place of the same q-gram
        before[order[again + 1]] = at[order[again]]
        reach, hits = int((self.size + self.most).max()), np.cumsum(n)
        found, lo = [], 0
        while True:  # parts of the text, each region whole in one of them
            hi = int(np.searchsorted(hits, MOST_HITS + (hits[lo - 1] if lo else 0), "right"))
            hi = max(hi, int(np.searchsorted(at, at[lo] + 2 * reach)))
            found += self._counted(at[lo:hi], before[lo:hi], first[lo:hi], n[lo:hi], len(text))
            if hi >= len(at):
                break
            lo = int(np.searchsorted(at, at[hi] - reach))
        return _merged(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else nothing

    def _counted(self, at: np.ndarray, before: np.ndarray, first: np.ndarray, n: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Regions by the counts of different places in each (pattern, band)."""
        own = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pattern = self.pattern[own]
        enough = np.bincount(pattern, minlength=len(self.size)) >= self.bound
        kept = enough[pattern]
        if not kept.any():
            return []
        patterns, number = np.flatnonzero(enough), np.cumsum(enough) - 1
        k, place = number[pattern[kept]], self.place[own[kept]]
        here, earlier = np.repeat(at, n)[kept], np.repeat(before, n)[kept]
        size, most, bound = self.size[patterns], self.most[patterns], self.bound[patterns]
        low, half = at[0] - size, most + 1
        found = []
        for shift in (0, 1):  # bands of width 2 (e + 1); each diagonal is in two of them
            origin = low - shift * half
            from_ = place + origin[k]
            width = 2 * half[k]
            band = (here - from_) // width
            once = (earlier < at[0]) | ((earlier - from_) // width != band)
            ends = np.cumsum((at[-1] - origin) // (2 * half) + 1)
            starts = ends - (at[-1] - origin) // (2 * half) - 1
            key = (starts[k] + band)[once]
            if ends[-1] <= 4 * len(key) + (1 << 20):
                count = np.bincount(key)
                bins = np.flatnonzero(count >= bound.min())
                count = count[bins]
            else:
                bins, count = np.unique(key, return_counts=True)
            own_k = np.searchsorted(ends, bins, "right")
            full = count >= bound[own_k]
            bins, own_k = bins[full], own_k[full]
            diagonal = origin[own_k] + (bins - starts[own_k]) * 2 * half[own_k]
            a = np.maximum(0, diagonal - most[own_k])
            z = np.minimum(length, diagonal + 2 * half[own_k] + size[own_k] + most[own_k])
            found.append((patterns[own_k], a, z))
        return found

    def matches(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(pattern, edits, start, end) of patterns within their budgets; of several regions that aren't exact, the best, and of equals the first to end."""
        left: dict[int, list[tuple[int, int, int]]] = {}
        for k, a, z in zip(*(x.tolist() for x in self.regions(np.frombuffer(text, np.uint8))), strict=True):
            pattern = self.patterns[k]
            exact = text.find(pattern, a, z)
            if exact >= 0:
                yield k, 0, exact, exact + len(pattern)
            else:
                left.setdefault((len(pattern) + 63) // 64, []).append((k, a, z))
        for words, regions in left.items():
            if len(regions) > 64 * words:  # many: one pass in lanes tells where each is best
                regions = self._best(text, regions, words)
            best: dict[int, tuple[int, int, int]] = {}
            for k, a, z in regions:
                hit = align(self.patterns[k], text[a:z], int(self.most[k]))
                if hit:
                    own = (hit[0], a + hit[2], a + hit[1])
                    best[k] = min(best.get(k, own), own)
            for k, (edits, end, start) in best.items():
                yield k, edits, start, end

    def _best(self, text: bytes, regions: list[tuple[int, int, int]], words: int) -> list[tuple[int, int, int]]:
        """Of each pattern, the region that matches best (of equals the one that ends first), if within its budget, cut to the match's surroundings."""
        best: dict[int, tuple[int, int, int]] = {}
        lanes = max(64, (1 << 15) // words)
        regions = sorted(regions, key=lambda r: r[2] - r[1])
        for lo in range(0, len(regions), lanes):
            own = regions[lo : lo + lanes]
            edits, ends = fewest_of_many([self.patterns[k] for k, _, _ in own], [text[a:z] for _, a, z in own])
            for (k, a, _), n, end in zip(own, edits.tolist(), ends.tolist(), strict=True):
                if n <= self.most[k] and (k not in best or (n, a + end) < (best[k][0], best[k][2])):
                    best[k] = (n, max(a, a + end - int(self.size[k] + self.most[k])), a + end)
        return [(k, a, z) for k, (_, a, z) in best.items()]


class Block:
    """Some items, their parts by the q-grams that suit them, and the short ones as words."""

    def __init__(self, items: list[tuple[int, bytes]], budget: float, window: int | None = WINDOW, whole_words_below: int = WHOLE_WORDS_BELOW) -> None:
        self.items = items
        self.short_items: dict[bytes, list[int]] = {}
        patterns: dict[int, list[tuple[int, bool, bytes, int]]] = {}
        for k, (_, text) in enumerate(items):
            parts = [text]
            if window and len(text) > window:
                parts += [text[a : a + window] for a in sorted({*range(0, len(text) - window, max(1, window // 2)), len(text) - window})]
            for i, part in enumerate(parts):
                most = int(budget * len(part))
                q = next((q for q in QS if len(part) - q + 1 - q * most >= 1), 0)
                if q and len(part) >= whole_words_below:
                    patterns.setdefault(q, []).append((k, i == 0, part, most))
                elif part:
                    self.short_items.setdefault(part, []).append(k)
        self.parts = [([(k, whole) for k, whole, _, _ in own], Index([p for *_, p, _ in own], [most for *_, most in own], q)) for q, own in patterns.items()]
        ordered = sorted(self.short_items, key=lambda t: (-len(t), t))
        self.short = re.compile(b"(?<![^ ])(?:" + b"|".join(map(re.escape, ordered)) + b")(?![^ ])") if ordered else None
        self.short_lengths = sorted({len(t) for t in ordered})

    def search(self, text: bytes) -> Iterator[tuple[int, int, int, int, bool]]:
        """(item, edits, start, end, whole): the best place of each item that the text holds, whole items before parts."""
        best: dict[int, tuple[bool, int, int, int]] = {}
        for owners, index in self.parts:
            for p, edits, start, end in index.matches(text):
                k, whole = owners[p]
                hit = (not whole, edits, start, end)
                if k not in best or hit < best[k]:
                    best[k] = hit
        if self.short:
            at = 0
            while m := self.short.search(text, at):
                at = m.start() + 1
                for n in self.short_lengths:
                    end = m.start() + n
                    if text[end : end + 1] in (b"", b" "):
                        for k in self.short_items.get(text[m.start() : end], ()):
                            best.setdefault(k, (False, 0, m.start(), end))
        for k, (part, edits, start, end) in sorted(best.items()):
            yield k, edits, start, end, not part


#: Blocks that a worker process keeps from task to task.
_kept: OrderedDict[str, Block] = OrderedDict()


def _block(name: str, items: list[tuple[int, bytes]], budget: float, window: int | None, whole_words_below: int) -> Block:
    if name not in _kept:
        _kept[name] = Block(items, budget, window, whole_words_below)
        while len(_kept) > BLOCKS_A_PASS:
            _kept.popitem(last=False)
    _kept.move_to_end(name)
    return _kept[name]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of bounded size, one block at a time on the driver."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        text = normalise(row["text"])
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def with_leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, window: int | None = WINDOW, block_bytes: int = BLOCK_BYTES, whole_words_below: int = WHOLE_WORDS_BELOW) -> DataFrame:
    """``docs`` with the column ``leaks_``, in the place of one so named: an array of (item_id, edits, start, end, whole),
    places in bytes of the normalised text."""
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext

    def search(items: list[tuple[int, bytes]]):
        shared, name = context.broadcast(items), uuid.uuid4().hex  # block_bytes at most, or one item

        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            block = _block(name, shared.value, budget, window, whole_words_below)
            for texts in batches:
                found = [[(block.items[k][0], *hit) for k, *hit in block.search(normalise(t.as_py()))] for t in texts]
                columns = list(zip(*(x for own in found for x in own), strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
                values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item_id", "edits", "start", "end", "whole"])
                yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), values)

        return F.arrow_udf(scan, HITS).asNondeterministic()  # else Spark runs it once more for a filter

    out = docs.withColumn("leaks_", F.array().cast(HITS))
    for i, items in enumerate(_blocks(benchmark, block_bytes)):
        if i and i % BLOCKS_A_PASS == 0:
            out = materialize(out, "leaks")
        out = out.withColumn("leaks_", F.concat("leaks_", search(items)("text")))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """A row for each document and item that it holds: doc_id, item_id, edits, start, end, whole."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_leaks(own, benchmark, **limits).select("doc_id", F.inline("leaks_"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """Documents without any benchmark item or part of one; a column named ``leaks_`` stays."""
    own = {c: f"{c}_own" for c in docs.columns if c.lower() == "leaks_"}
    kept = with_leaks(docs.withColumnsRenamed(own), benchmark, **limits).filter(F.size("leaks_") == 0).drop("leaks_")
    return kept.withColumnsRenamed({v: k for k, v in own.items()})
