"""Token ids of whole texts by the ``tokenizers`` library, with a word memo.

The vocabulary's pre-tokenizer always breaks at white space and its normaliser works
on single characters and combining sequences, so a text's ids are the ids of its
white-space-separated words, one after another. Each worker process remembers the ids
of the words it has met, which spares most calls into the library; the ids themselves
always come from it.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

#: Most entries that a worker remembers of words, of stems of letters, and of other parts; what comes later is looked up anew in each batch.
MEMO_WORDS = 900_000
MEMO_STEMS = 700_000
MEMO_OTHERS = 50_000
#: Missing words given to the library in one string, apart from each other by a sentinel word.
JOINED = 128
SENTINEL = "dog"

#: ASCII punctuation without the apostrophe, which may begin a contraction (a fixed value).
PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'

_encoders: dict[str, WordEncoder] = {}


def _one_pre_token(stem: str) -> bool:
    """True if the normalised stem is letters only, so that punctuation after it starts a new pre-token."""
    return unicodedata.normalize("NFC", stem).lower().isalpha()


class Memo(dict):
    """A bounded map and, beside it, what only the present batch needs."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.extra: dict[bytes, bytes] = {}

    def __missing__(self, key: bytes) -> bytes:
        return self.extra[key]

    def add(self, entries: dict[bytes, bytes]) -> None:
        (self if len(self) + len(entries) <= self.most else self.extra).update(entries)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Memo(MEMO_WORDS)
        self.stems = Memo(MEMO_STEMS)
        self.others = Memo(MEMO_OTHERS)
        ids = self.tokenizer.encode(SENTINEL, add_special_tokens=False).ids
        self.sentinel = ids[0] if len(ids) == 1 else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _library(self, words: list[bytes], letters: bool) -> list[bytes]:
        """Ids of each word, many words to a string: words of letters end where a pre-token ends,
        others are parted by the sentinel word; a string that doesn't fall apart so is done word by word."""
        groups = [[w.decode() for w in words[i : i + JOINED]] for i in range(0, len(words), JOINED)]
        glue = " " if letters else f" {SENTINEL} "
        out: list[bytes] = []
        for group, encoding in zip(groups, self.tokenizer.encode_batch_fast([glue.join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, dtype="<u4")
            if letters and len(cuts := np.flatnonzero(self.ends[ids]) + 1) == len(group):
                out += [ids[a:b].tobytes() for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]
            elif not letters and len(cuts := np.flatnonzero(ids == self.sentinel)) == len(group) - 1:
                edges = [-1, *cuts.tolist(), len(ids)]
                out += [ids[a + 1 : b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            else:
                out += [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
        return out

    def _learn(self, words: set[bytes]) -> None:
        """Put words into the memo: as stem and punctuation where they part there, else whole."""
        stems, others, parted, found = self.stems, self.others, {}, {}
        for w in words:
            stem = w.rstrip(PUNCTUATION)
            if stem.isalpha() or stem in stems or (not stem.isascii() and _one_pre_token(stem.decode())):
                parted[w] = stem
        whole = [w for w in words if w not in parted]
        letters = {s for s in parted.values() if s not in stems}
        stops = {w[len(s) :] for w, s in parted.items() if len(s) < len(w)}
        for kind, memo, new in ((True, stems, letters), (False, others, {*whole, *stops})):
            fresh = sorted(w for w in new if w not in memo)
            memo.add(dict(zip(fresh, self._library(fresh, kind), strict=True)))
        for w, stem in parted.items():
            found[w] = stems[stem] if len(stem) == len(w) else stems[stem] + others[w[len(stem) :]]
        for w in whole:
            found[w] = others[w]
        self.words.add(found)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every whole text; null counts as empty."""
        split = [(t or "").encode().lower().split() for t in texts]
        found = [list(map(self.words.get, words)) for words in split]  # each word is looked up once
        holes = [[i for i, x in enumerate(ids) if x is None] for ids in found]
        if missing := {words[i] for words, at in zip(split, holes, strict=True) for i in at}:
            self._learn(missing)
            own = self.words.__getitem__
            for words, ids, at in zip(split, found, holes, strict=True):
                for i in at:
                    ids[i] = own(words[i])
        out = [b"".join(ids) for ids in found]
        self.words.extra, self.stems.extra, self.others.extra = {}, {}, {}
        return out


def encoder(path: str) -> WordEncoder:
    """The worker process's encoder for the vocabulary file at ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
