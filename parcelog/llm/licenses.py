"""License scans: passages compared with licence templates by Dice over word bigrams.

Texts and templates are normalised (ASCII letters lower, ASCII punctuation to spaces).
Passages are the lines of a text, the sentences of lines that hold several, paragraphs
of several lines, and the whole text. The Dice coefficient is twice the bigrams in
common, repeats counted, by the bigrams of both. A coefficient of t or more is only
possible if the sizes' ratio lies between t / (2 - t) and its inverse, which prunes the
templates a passage is compared with, and if t / (2 - t) of the passage's bigrams are in
the template, which prunes passages by the words that templates know.

With ``windows``, every run of as many words as a template has that begins with one of its
bigrams is a passage for that template, too, wherever lines and paragraphs end: notices
wrapped inside a paragraph, split by empty comment lines or put between other text are
found. Only templates of which enough bigrams stand in the text are slid over it. Windows
of one licence that overlap are one passage; of those of several licences the one with most
bigrams in common stays. ``n_passages`` is the greater of the numbers of passages that
either way finds.

Templates are a parameter of bounded size (they go to tasks with the code); ``read_templates``
takes them from files, for instance full licence texts. Defined
cases: null and empty texts, and passages of fewer than two words, match nothing; equal
best templates are each reported; null ids and repeated rows are reported like others;
an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelog.storage import small_batches

THRESHOLD = 0.8
FOUND = "array<struct<license:string,dice:double,n_passages:long>>"

#: Public licence notices and texts (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: More notices and full short licences, for windows (fixed values). Longer texts come from files.
MORE_TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions."),
)

_PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
_SENTENCE = re.compile(r"(?<=[.;!?])[ \t]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().translate(_PUNCTUATION).split()


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


class Windows:
    """Templates slid over the words of a text."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float) -> None:
        self.threshold = threshold
        known = [(name, bigrams(words)) for name, text in templates if len(words := words_of(text)) > 1]
        self.names, self.counts = [name for name, _ in known], [own for _, own in known]
        self.size = np.array([own.total() for own in self.counts])
        self.words = {w: i for i, w in enumerate(sorted({w for own in self.counts for pair in own for w in pair}))}
        # The templates of each bigram, bigrams as numbers in ascending order.
        rows = sorted((self.words[a] * len(self.words) + self.words[b], t, n) for t, own in enumerate(self.counts) for (a, b), n in own.items())
        self.pair, self.first = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True)
        self.first = np.append(self.first, len(rows))
        self.template = np.array([r[1] for r in rows], np.int64)
        self.times = np.array([r[2] for r in rows], np.int64)

    def find(self, words: list[bytes]) -> dict[str, list[float]]:
        """The best coefficient of each passage, by licence."""
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        pair = ids[at] * len(self.words) + ids[at + 1]
        k = np.minimum(np.searchsorted(self.pair, pair), max(0, len(self.pair) - 1))
        hit = self.pair[k] == pair if len(self.pair) else np.zeros(len(at), bool)
        at, k = at[hit], k[hit]
        if not len(at):
            return {}
        # A template needs enough of its bigrams in the text, each as often as it has it at most.
        met, n = np.unique(k, return_counts=True)
        rows = np.concatenate([np.arange(self.first[i], self.first[i + 1]) for i in met])
        often = np.repeat(n, self.first[met + 1] - self.first[met])
        common = np.bincount(self.template[rows], np.minimum(often, self.times[rows]), len(self.size))
        # Windows at the text's end may be shorter than the template.
        found: dict[str, list[tuple[int, int, int, float]]] = {}
        for t in np.flatnonzero(2 * common >= self.threshold * (self.size + np.minimum(self.size, common)) - 1e-9).tolist():
            if windows := self._slide(t, words, at.tolist()):
                found.setdefault(self.names[t], []).extend(windows)
        passages = [(common, dice, a, z, name) for name, windows in found.items() for a, z, common, dice in _joined(windows)]
        taken, out = np.zeros(len(words), np.int64), {}
        for common, dice, a, z, name in sorted(passages, reverse=True):
            if taken[a:z].max() <= common:
                taken[a:z] = common
                out.setdefault(name, []).append(dice)
        return out

    def _slide(self, t: int, words: list[bytes], at: list[int]) -> list[tuple[int, int, int, float]]:
        """(first word, end, bigrams in common, coefficient) of the windows of a template that reach the threshold."""
        own, size, last = self.counts[t], int(self.size[t]), len(words) - 1
        places = [i for i in at if (words[i], words[i + 1]) in own]
        seen: Counter = Counter()
        common, end, out = 0, 0, []
        for start in places:
            while end < len(places) and places[end] < start + size:
                pair = (words[places[end]], words[places[end] + 1])
                seen[pair] += 1
                common += seen[pair] <= own[pair]
                end += 1
            dice = 2 * common / (size + min(size, last - start))
            if dice >= self.threshold:
                out.append((start, min(start + size, last) + 1, common, dice))
            pair = (words[start], words[start + 1])
            common -= seen[pair] <= own[pair]
            seen[pair] -= 1
        return out


def _joined(windows: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Windows that overlap as one, with the most bigrams in common and the best coefficient of any."""
    out: list[tuple[int, int, int, float]] = []
    for a, z, common, dice in sorted(windows):
        if out and a < out[-1][1]:
            begin, end, most, best = out.pop()
            a, z, common, dice = begin, max(end, z), max(most, common), max(best, dice)
        out.append((a, z, common, dice))
    return out


class Templates:
    """Templates by size, and the words that they know."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float, windows: bool = False) -> None:
        self.windows = Windows(templates, threshold) if windows else None
        self.least = threshold / (2 - threshold)
        self.threshold = threshold
        self.by_size: dict[int, list[tuple[str, Counter]]] = defaultdict(list)
        for name, text in templates:
            own = bigrams(words_of(text))
            if own:
                self.by_size[own.total()].append((name, own))
        self.words = {w for own in self.by_size.values() for _, b in own for pair in b for w in pair}
        self.smallest, self.largest = min(self.by_size, default=1) * self.least, max(self.by_size, default=0) / self.least

    def best(self, words: list[bytes]) -> list[tuple[str, float]]:
        """(licence, coefficient) of the templates that a passage resembles most, if enough."""
        n = len(words) - 1
        if not max(1, self.smallest - 1e-9) <= n <= self.largest + 1e-9:
            return []
        own, found = bigrams(words), {}
        for size, templates in self.by_size.items():
            if size * self.least <= n + 1e-9 and n * self.least <= size + 1e-9:
                for name, other in templates:
                    dice = 2 * (own & other).total() / (n + size)
                    if dice >= self.threshold:
                        found[name] = max(dice, found.get(name, 0.0))
        most = max(found.values(), default=0.0)
        return sorted((k, v) for k, v in found.items() if v == most)

    def scan(self, text: str | None) -> list[tuple[str, float, int]]:
        """(licence, best coefficient, passages) of a whole text."""
        found: dict[str, list[float]] = defaultdict(list)

        def take(words: list[bytes], known: int) -> None:
            # Each bigram in common has two known words, so at least one word more than those bigrams is known.
            if known >= self.least * (len(words) - 1) - 1e-9:
                for name, dice in self.best(words):
                    found[name].append(dice)

        every, all_known, block, block_known, lines, blocks = [], 0, [], 0, 0, 0
        for line in [*(text or "").split("\n"), ""]:
            words = words_of(line)
            if words:
                known = sum(map(self.words.__contains__, words))
                take(words, known)
                if known >= self.smallest and len(parts := _SENTENCE.split(line)) > 1:
                    for part in parts:
                        own = words_of(part)
                        take(own, len(own))
                block += words
                block_known += known
                lines += 1
            elif block:
                if lines > 1:
                    take(block, block_known)
                every += block
                all_known += block_known
                blocks += 1
                block, block_known, lines = [], 0, 0
        if blocks > 1:
            take(every, all_known)
        if self.windows and len(every) > 1:
            for name, groups in self.windows.find(every).items():
                plain = found[name]
                found[name] = [max(plain + groups)] * max(len(plain), len(groups))
        return sorted((k, max(v), len(v)) for k, v in found.items())


def read_templates(spark: SparkSession, *paths: str) -> tuple[tuple[str, str], ...]:
    """(licence, text) for each file, whole; the name is the file's without its suffix. Few and small files: they go to every task."""
    rows = spark.read.text(list(paths), wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value")
    return tuple((unquote(r["name"]).removesuffix(".txt"), r["value"]) for r in rows.orderBy("name").collect())


def licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, windows: bool = False) -> DataFrame:
    """A row for each document and licence found in it: doc_id, license, dice (the best), n_passages."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Templates(templates, threshold, windows)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("n_passages", pa.int64())]))
        for texts in batches:
            yield pa.array([[{"license": a, "dice": b, "n_passages": c} for a, b, c in known.scan(t.as_py())] for t in texts], kind)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.arrow_udf(scan, FOUND).asNondeterministic()("text").alias("found"))
    return found.select("doc_id", F.inline("found"))
