"""Licence scan: passages of a text against licence templates by the Dice coefficient over word bigrams.

Passages are the lines, the paragraphs (parted by blank lines) and the whole text. Words are folded as in `text`; a passage
of m bigrams and a template of n share c of them (each counted as often as it occurs in both), and score 2c / (m + n). As c
is at most the smaller of m and n, a score of t needs m between n t / (2 - t) and n (2 - t) / t: templates of other sizes
are not compared. Of the rest, only passages with enough bigrams from any template are.

With `inside`, any run of words of a text is a passage too, so that a licence of several paragraphs in a longer text, or a
notice within a line, is found. The best run begins and ends with a bigram of the template, as leaving out another one at an
end raises the score, and holds at least n t / (2 - t) of them: all runs from places where that many lie close are scored.

Defined cases: null, empty and one-word passages have no bigram and match nothing; of passages that match a template equally
well the first counts, a line, paragraph or text before a run with its start; equal rows get equal results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm import text as T

THRESHOLD = 0.85

# fixed values: the wording of public licences and of their usual notices, by SPDX identifier; several texts may share one
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}


def bigrams(hashes: np.ndarray) -> np.ndarray:
    return T.grams(hashes, 2)


class Templates:
    def __init__(self, texts: Mapping[str, list[str]], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be above 0, at most 1")
        self.threshold = threshold
        self.names, self.counts = [], []
        for name in sorted(texts):
            for text in texts[name]:
                hashes, _, _ = T.words(next(T.slices(pa.array([text]))))
                if len(hashes) >= 2:
                    self.names.append(name)
                    self.counts.append(Counter(bigrams(hashes).tolist()))
        self.sizes = np.array([sum(c.values()) for c in self.counts], np.int64)
        self.known = np.array(sorted(set().union(*self.counts)) if self.counts else [], np.uint64)
        self.low = np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9)
        self.high = np.floor(self.sizes * (2 - threshold) / threshold + 1e-9)
        self.held = np.array([[c[k] for k in self.known.tolist()] for c in self.counts], np.int64)

    def possible(self, grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Passages of a template's size range that hold enough known bigrams for the smallest such template."""
        out = np.zeros(len(sizes), bool)
        if not len(self.known) or not len(grams):
            return out
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        before = np.concatenate([[0], np.cumsum(self.known[at] == grams)])
        held = before[starts + sizes] - before[starts]
        for size, low, high in zip(self.sizes, self.low, self.high):
            needed = self.threshold * (sizes + size) / 2 - 1e-9
            out |= (sizes >= low) & (sizes <= high) & (held >= needed)
        return out

    def scores(self, grams: np.ndarray) -> Iterator[tuple[str, float]]:
        own = Counter(grams.tolist())
        m = len(grams)
        for name, count, n, low, high in zip(self.names, self.counts, self.sizes.tolist(), self.low, self.high):
            if low <= m <= high:
                score = 2 * (own & count).total() / (m + n)
                if score >= self.threshold:
                    yield name, score

    def runs(self, grams: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, str, float, int, int]]:
        """Row, licence, score, first and last bigram of the best run of each row and template; row -1: between two rows."""
        if not len(self.known) or not len(grams):
            return
        symbols = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        places = np.flatnonzero((self.known[symbols] == grams) & (rows >= 0))
        symbols = symbols[places]
        for name, held, n, low, high in zip(self.names, self.held, self.sizes.tolist(), self.low, self.high):
            own = held[symbols] > 0
            at, symbol, least = places[own], symbols[own], max(int(low), 1)
            if len(at) < least:
                continue
            row, heads = rows[at], len(at) - least + 1
            some = np.flatnonzero((at[least - 1 :] - at[:heads] < high) & (row[least - 1 :] == row[:heads]))
            if not len(some):
                continue
            order = np.argsort(symbol, kind="stable")
            heads = np.flatnonzero(np.diff(symbol[order], prepend=-1))
            nth = np.empty(len(at), np.int64)  # equal bigrams before this one
            nth[order] = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
            stops = np.minimum(np.searchsorted(at, at[some] + int(high)), np.searchsorted(row, row[some], "right"))
            passed, done = np.zeros(len(self.known), np.int64), 0  # bigrams before the run
            best: dict[int, tuple[float, int, int]] = {}
            for i, stop in zip(some.tolist(), stops.tolist()):
                r = int(row[i])
                if r in best and best[r][0] == 1:
                    continue
                np.add.at(passed, symbol[done:i], 1)
                done = i
                inside = symbol[i:stop]
                common = np.cumsum(nth[i:stop] - passed[inside] < held[inside])
                score = 2 * common / (at[i:stop] - at[i] + 1 + n)
                last = int(np.argmax(score))
                if score[last] >= self.threshold and (r not in best or score[last] > best[r][0]):
                    best[r] = float(score[last]), int(at[i]), int(at[i + last])
            for r, (score, first, last) in best.items():
                yield r, name, score, first, last


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last byte of each line, of each paragraph of several lines, and of each text of several paragraphs."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    row = np.searchsorted(bounds, starts, "right") - 1
    visible = np.concatenate([[0], np.cumsum((data != 32) & ((data < 9) | (data > 13)))])
    blank = visible[ends] == visible[starts]
    head = np.ones(len(starts), bool)  # first line of a paragraph
    head[1:] = blank[:-1] | (row[1:] != row[:-1])
    head &= ~blank
    group = np.cumsum(head)
    found = [(row[~blank], starts[~blank], ends[~blank])]
    for key in (group, row):
        keyed = key[~blank]
        first = np.flatnonzero(np.diff(keyed, prepend=-1))
        last = np.append(first[1:], len(keyed)) - 1
        several = last > first
        if key is row and len(first):
            several &= group[~blank][first] != group[~blank][last]
        r, s, e = found[0]
        found.append((r[first[several]], s[first[several]], e[last[several]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def word_end(part: T.Slice, places: np.ndarray, word: int, row: int) -> int:
    """The byte after a word."""
    stop = part.bounds[row + 1] if word + 1 == len(places) else min(part.bounds[row + 1], places[word + 1])
    gaps = np.flatnonzero(~T.IS_WORD[part.data[places[word] : stop]])
    return int(places[word] + gaps[0] if len(gaps) else stop)


def scan(documents: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, *, threshold: float = THRESHOLD,
         inside: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document and licence found: doc_id, license, score, passage (its text), start (its first byte).

    `inside` also finds licences that are only a part of a line or of a text of several paragraphs.
    `templates` is a short list that goes to every task; the texts are read once and nothing is shuffled.
    """
    known = Templates(templates, threshold)
    ids = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                if not len(part.data):
                    continue
                hashes, places, before = T.words(part)
                grams = bigrams(hashes)
                row, start, end = passages(part.data, part.bounds)
                first, last = np.searchsorted(places, start), np.searchsorted(places, end)
                sizes = np.maximum(last - first - 1, 0)
                some = np.flatnonzero((sizes > 0) & known.possible(grams, np.minimum(first, len(grams)), sizes))
                best: dict[tuple[int, str], tuple[float, int, bool, int]] = {}
                for i in some:
                    for name, score in known.scores(grams[first[i] : first[i] + sizes[i]]):
                        key, value = (int(row[i]), name), (score, -int(start[i]), True, -int(end[i]))
                        best[key] = max(best.get(key, value), value)
                if inside:
                    holder = np.searchsorted(before, np.arange(len(places)), "right") - 1
                    owner = np.where(holder[1:] == holder[:-1], holder[:-1], -1)
                    for r, name, score, a, b in known.runs(grams, owner):
                        key, value = (r, name), (score, -int(places[a]), False, -word_end(part, places, b + 1, r))
                        best[key] = max(best.get(key, value), value)
                rows = sorted(best)
                texts = [
                    part.data[-best[k][1] : -best[k][3]].tobytes().decode("utf-8", "replace").strip() for k in rows
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([part.first + r for r, _ in rows], pa.int64())),
                        pa.array([name for _, name in rows], pa.string()),
                        pa.array([best[k][0] for k in rows], pa.float64()), pa.array(texts, pa.string()),
                        pa.array([int(-best[k][1] - part.bounds[k[0]]) for k in rows], pa.int64()),
                    ],
                    ["doc_id", "license", "score", "passage", "start"],
                )

    return ids.mapInArrow(run, f"doc_id {id_type}, license string, score double, passage string, start long")
