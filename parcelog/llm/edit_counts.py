"""Edit-aware token counts: a segment tree of pre-token runs for each document.

A text is cut into leaves of about ``LEAF`` characters where white space begins; the
vocabulary's pre-tokens never reach over such a place, so the leaves' token counts add
up. A balanced tree over the leaves holds sums of their lengths and counts. An edit finds its
leaves by place, takes a neighbour in where it touches a leaf's border, encodes that region
anew, cut into as many leaves as it now needs, and updates the sums above; what is left of
little text joins the leaf before it. The rest of the text is never encoded again.

``leaf_lengths`` and ``leaf_counts`` of a document are its tree's state: they are kept as
columns, and a later run takes them up instead of encoding the text. A state that can't be the
text's (its lengths don't add up, or part the text where no leaf may begin) is left alone, and
the text counted anew; counts that are wrong for the right lengths can't be noticed.

Edits are done from the last to the first, so all places mean the text as it was; texts put
in at one place stand there in the edits' order. Edits that overlap others or reach beyond
the text are refused: by default with an error, as what follows would count another text
than meant; with ``refuse="skip"`` those that overlap an earlier one (by place, then order)
or reach beyond are left out and counted in ``n_refused``, and the job goes on.

Defined cases: null and empty texts have no tokens; null edits, and edits with a null
place, are none, a null replacement is the empty text; repeated rows and null ids are
counted like others; an empty table gives no rows; other columns stay with their rows, but
for one with the result's name, which the result replaces (``name`` chooses another).
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from parcelog.llm.spans import let, matches, pieces, sums_before
from parcelog.llm.tokens import encoder
from parcelog.storage import small_batches

LEAF = 512
EDITS = "array<struct<start:int,end:int,text:string>>"
COUNTS = "struct<n_edits:long,n_refused:long,n_tokens_before:long,n_tokens:long,n_chars_encoded:long,leaf_lengths:array<int>,leaf_counts:array<int>>"
#: Personal data that the sample edits mask: mail addresses, network addresses and long numbers (fixed values).
MASKS = ((r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<mail>"), (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", "<address>"), (r"\b[0-9]{8,}\b", "<number>"))

_BORDER = re.compile(r"(?<=[^ \n\t\r])(?=[ \n\t\r])")


class Node:
    """A leaf's text and token count, with the sums of lengths and counts of the subtree that it is the root of."""

    __slots__ = ("text", "count", "rank", "left", "right", "length", "total")

    def __init__(self, text: str, count: int, rank: float) -> None:
        self.text, self.count, self.rank = text, count, rank
        self.left: Node | None = None
        self.right: Node | None = None
        self.update()

    def update(self) -> Node:
        self.length, self.total = len(self.text), self.count
        for side in (self.left, self.right):
            if side:
                self.length += side.length
                self.total += side.total
        return self


def merged(a: Node | None, b: Node | None) -> Node | None:
    """One tree of two that follow each other: roots by rank, which are random, so depths are logarithmic."""
    if not a or not b:
        return a or b
    if a.rank < b.rank:
        a.right = merged(a.right, b)
        return a.update()
    b.left = merged(a, b.left)
    return b.update()


def parted(node: Node | None, place: int) -> tuple[Node | None, Node | None]:
    """Two trees: leaves that begin before ``place``, and the others."""
    if not node:
        return None, None
    before = node.left.length if node.left else 0
    if before < place:
        node.right, rest = parted(node.right, place - before - len(node.text))
        return node.update(), rest
    first, node.left = parted(node.left, place)
    return first, node.update()


def leaves_of(node: Node | None) -> Iterator[Node]:
    """Leaves in order."""
    above: list[Node] = []
    while above or node:
        while node:
            above.append(node)
            node = node.left
        node = above.pop()
        yield node
        node = node.right


class EditTree:
    """Token count of one text under edits."""

    def __init__(self, text: str, encode, lengths: list[int] | None = None, counts: list[int] | None = None) -> None:
        self.encode, self.encoded, self.ranks = encode, 0, random.Random(len(text))
        if _is_state(text, lengths, counts):
            ends = list(accumulate(lengths, initial=0))
            leaves = [text[a:b] for a, b in pairwise(ends)]
        else:
            leaves = cut(text)
            counts = self._count(leaves)
            self.encoded = 0  # the first count isn't an edit's
        self.root = self._tree(leaves, counts)

    def _count(self, texts: list[str]) -> list[int]:
        self.encoded += sum(map(len, texts))
        return [len(x) // 4 for x in self.encode(texts)]

    def _tree(self, leaves: list[str], counts: list[int]) -> Node | None:
        root = None
        for text, count in zip(leaves, counts, strict=True):
            root = merged(root, Node(text, count, self.ranks.random()))
        return root

    @property
    def n_tokens(self) -> int:
        return self.root.total if self.root else 0

    @property
    def leaves(self) -> list[str]:
        return [leaf.text for leaf in leaves_of(self.root)]

    def edit(self, start: int, end: int, text: str) -> None:
        """Put ``text`` in the place of the characters from ``start`` to ``end``."""
        if not 0 <= start <= end <= (self.root.length if self.root else 0):
            raise ValueError("an edit reaches beyond its text")
        # The region: leaves that the edit touches, with the one before a start and the one after an end at a border.
        before, region = self._with_last(*parted(self.root, start))
        region, after = parted(region, end + 1 - (before.length if before else 0))
        begin = before.length if before else 0
        new = self._put(region, start - begin, end - begin, text)
        if len(new) < LEAF // 4 and before:  # little is left: one leaf with the neighbour
            before, neighbour = self._with_last(before, None)
            new = neighbour.text + new
        parts = cut(new)
        self.root = merged(merged(before, self._tree(parts, self._count(parts))), after)

    @staticmethod
    def _with_last(first: Node | None, rest: Node | None) -> tuple[Node | None, Node | None]:
        """The last leaf of ``first`` moved to the front of ``rest``."""
        if not first:
            return first, rest
        last = first
        while last.right:
            last = last.right
        first, own = parted(first, first.length - len(last.text))
        return first, merged(own, rest)

    @staticmethod
    def _put(region: Node | None, start: int, end: int, text: str) -> str:
        old = "".join(leaf.text for leaf in leaves_of(region))
        return old[:start] + text + old[end:]


def _is_state(text: str, lengths: list[int] | None, counts: list[int] | None) -> bool:
    """True if leaves of these lengths may be a state of the text: they add up to it and part it where leaves may begin."""
    if lengths is None or counts is None or len(lengths) != len(counts) or None in lengths or None in counts:
        return False
    ends = list(accumulate(lengths, initial=0))
    return ends[-1] == len(text) and min(lengths, default=1) > 0 and min(counts, default=0) >= 0 and all(_BORDER.match(text, at) for at in ends[1:-1])


def cut(text: str) -> list[str]:
    """Leaves of about LEAF characters that begin, but for the first, with white space after something else."""
    borders, out, at = [m.start() for m in _BORDER.finditer(text)] if len(text) > LEAF else [], [], 0
    k = bisect_left(borders, LEAF)
    while k < len(borders):
        out.append(text[at : borders[k]])
        at = borders[k]
        k = bisect_left(borders, at + LEAF, k)
    return [*out, text[at:]] if at < len(text) else out


def in_order(edits: list[dict | None] | None, length: int, strict: bool) -> tuple[list[dict], int]:
    """Edits from the last to the first, and the number of those refused."""
    known = [(e["start"], e["end"], i, e["text"] or "") for i, e in enumerate(edits or []) if e and e["start"] is not None and e["end"] is not None]
    taken, free = [], 0
    for start, end, _, text in sorted(known):
        if free <= start <= end <= length:
            taken.append((start, end, text))
            free = end
        elif strict:
            raise ValueError("an edit reaches beyond its text" if not 0 <= start <= end <= length else "edits overlap")
    return taken[::-1], len(known) - len(taken)


def with_counts(docs: DataFrame, tokenizer_path: str, refuse: str = "error", name: str = "counts") -> DataFrame:
    """``docs`` with the struct ``counts``; reads text, edits and, where there are such columns, leaf_lengths and leaf_counts."""
    if refuse not in ("error", "skip"):
        raise ValueError("refuse is error or skip")
    small_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == name.lower()])
    own = docs.withColumn("edits", F.col("edits").cast(EDITS))
    kind = pa.struct([*[(k, pa.int64()) for k in ("n_edits", "n_refused", "n_tokens_before", "n_tokens", "n_chars_encoded")], ("leaf_lengths", pa.list_(pa.int32())), ("leaf_counts", pa.list_(pa.int32()))])
    schema = T.StructType([*own.schema.fields, T.StructField(name, T._parse_datatype_string(COUNTS))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            out = []
            nothing = [None] * batch.num_rows
            state = [batch.column(k).to_pylist() if k in batch.schema.names else nothing for k in ("leaf_lengths", "leaf_counts")]
            for text, edits, lengths, counts in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), *state, strict=True):
                tree = EditTree(text or "", encode, lengths, counts)
                before = tree.n_tokens
                edits, refused = in_order(edits, len(text or ""), refuse == "error")
                for start, end, new in edits:
                    tree.edit(start, end, new)
                own = [(len(leaf.text), leaf.count) for leaf in leaves_of(tree.root)]
                out.append({"n_edits": len(edits), "n_refused": refused, "n_tokens_before": before, "n_tokens": tree.n_tokens, "n_chars_encoded": tree.encoded, "leaf_lengths": [a for a, _ in own], "leaf_counts": [b for _, b in own]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, name])

    return own.mapInArrow(count, schema)


def mask_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``edits``: masks for personal data, of overlapping ones the first kind's."""

    def extended(piece: Column, edits: Column, kinds: tuple[tuple[str, str], ...]) -> Column:
        if not kinds:
            return edits
        pattern, mask = kinds[0]
        free = F.filter(matches(piece, pattern), lambda m: ~F.exists(edits, lambda e: (e["start"] < m["end"]) & (m["start"] < e["end"])))
        new = F.transform(free, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(mask).alias("text")))
        return let(F.concat(edits, new), lambda found: extended(piece, found, kinds[1:]))

    cut = pieces(F.coalesce("text", F.lit("")), r"\s")
    moved = lambda t, at: F.transform(extended(t, F.array().cast(EDITS), MASKS), lambda e: F.struct((at + e["start"]).alias("start"), (at + e["end"]).alias("end"), e["text"].alias("text")))
    return docs.withColumn("edits", let(cut, lambda own: F.flatten(F.zip_with(own, sums_before(F.transform(own, F.length)), moved))).cast(EDITS))


def masked_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Token counts of every document before and after its personal data are masked."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_counts(mask_edits(own), tokenizer_path).select("doc_id", *[F.col(f"counts.{c}").alias(c) for c in ("n_edits", "n_tokens_before", "n_tokens", "n_chars_encoded")])
