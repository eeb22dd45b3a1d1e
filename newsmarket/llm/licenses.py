"""Licence scans by Dice coefficient over word bigrams.

A unit (the whole text, one line of it, or a passage of any words in a row) is normalised: lower case, signs and numbers of
versions kept as words, the rest blank. Its multiset of word bigrams is compared with that of each
licence template: 2 * |A and B| / (|A| + |B|). A template can reach the threshold only if the
sizes are within a factor of (2 - t) / t, so candidates come from that range of sizes and share
a bigram. A passage that reaches the threshold holds t / (2 - t) of the template's bigrams within
(2 - t) / t of its size, so only places with so many of them are looked at, and there all passages
that begin and end with one of its bigrams are compared.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches

THRESHOLD = 0.8
#: Templates that are compared, with their characters, at most; more are refused.
MOST_TEMPLATES, MOST_CHARS = 5_000, 20_000_000

# Notices and short licence texts.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT-notice": "Released under the MIT License.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
}
TEMPLATES |= {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

_SIGNS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_SIGNS_BUT_LINES = _SIGNS[:10] + b"\n" + _SIGNS[11:]
_SCHEMA = "doc_id long, unit string, line int, template string, dice double"


def normalised(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split()


def bigrams(words: list[bytes]) -> Counter:
    """The multiset of word pairs; a single word is a pair with nothing."""
    return Counter(zip(words, words[1:], strict=False)) if len(words) != 1 else Counter([(words[0], b"")])


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Templates:
    """Templates by size of their bigrams; what each task gets."""

    def __init__(self, texts: dict[str, str], threshold: float = THRESHOLD):
        if len(texts) > MOST_TEMPLATES or sum(map(len, texts.values())) > MOST_CHARS:
            raise ValueError("too many templates for one pass; scan with parts of them")
        grams = sorted(((g := bigrams(normalised(t))).total(), name, g) for name, t in texts.items())
        self.grams = [(name, g) for n, name, g in grams if n]
        self.sizes = [n for n, _, g in grams if n]
        self.threshold = threshold
        self.words = frozenset(w for _, g in self.grams for pair in g for w in pair if w)
        low, high = (2 - threshold) / threshold, threshold / (2 - threshold)
        self.shortest, self.longest = (max(1, int(min(self.sizes) * high)), int(max(self.sizes) * low) + 3) if self.sizes else (1, 1)

        self.pairs = {pair: k for k, pair in enumerate(dict.fromkeys(pair for _, g in self.grams for pair in g))}
        own = sorted((self.pairs[pair], i, n) for i, (_, g) in enumerate(self.grams) for pair, n in g.items())
        self.of_pair, self.owner, self.times = (np.array([x[k] for x in own], np.int64) for k in range(3))
        self.least = np.ceil(np.array(self.sizes, float) * threshold / (2 - threshold) - 1e-9).astype(np.int64)
        self.lone = {pair[0]: name for name, g in reversed(self.grams) for pair in g if pair[1] == b""}

    def passages(self, words: list[bytes]) -> list[tuple[int, int, int, str, float]]:
        """(first word, word after the last, shared pairs, template, dice): the best passages that don't overlap for each template."""
        out = [(k, k + 1, 1, self.lone[w], 1.0) for k, w in enumerate(words) if w in self.lone] if self.lone else []
        at = np.fromiter(map(self.pairs.get, zip(words, words[1:], strict=False), repeat(-1)), np.int64, max(0, len(words) - 1))
        place = np.flatnonzero(at >= 0)
        if len(place) < self.least.min(initial=1 << 40):
            return out
        lo, hi = np.searchsorted(self.of_pair, at[place]), np.searchsorted(self.of_pair, at[place], "right")
        many = hi - lo
        entry = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        place, owner = np.repeat(place, many), self.owner[entry]
        enough = np.bincount(owner, minlength=len(self.sizes)) >= self.least
        for i in np.flatnonzero(enough):
            mine = owner == i
            out += self._of_template(int(i), place[mine], entry[mine])
        return out

    def _of_template(self, i: int, place: np.ndarray, entry: np.ndarray) -> list[tuple[int, int, int, str, float]]:
        size, least, t, name = self.sizes[i], max(1, int(self.least[i])), self.threshold, self.grams[i][0]
        widest = int(size * (2 - t) / t + 1e-9)
        starts = np.flatnonzero(place[least - 1 :] - place[: len(place) - least + 1] < widest)
        # A pair counts from a start on unless the template's number of it lies between.
        before, seen = np.full(len(place), -1, np.int64), {}
        for k, e in enumerate(entry.tolist()):
            old = seen.setdefault(e, [])
            if len(old) >= self.times[e]:
                before[k] = old[len(old) - self.times[e]]
            old.append(k)
        found = []
        for s in starts.tolist():
            end = int(np.searchsorted(place, place[s] + widest))
            shared = np.cumsum(before[s:end] < s)
            score = 2 * shared / (place[s:end] - place[s] + 1 + size)
            best = int(score.argmax())
            if score[best] >= t - 1e-12:
                found.append((-float(score[best]), int(place[s]), int(place[s + best]) + 2, int(shared[best])))
        return _apart([(first, last, shared, name, round(-d, 9)) for d, first, last, shared in sorted(found)])

    def best(self, words: list[bytes]) -> tuple[str, float] | None:
        """The template with the largest coefficient of the threshold or more; ties to the first name."""
        n = max(len(words) - 1, min(len(words), 1))
        t = self.threshold
        lo, hi = bisect_left(self.sizes, n * t / (2 - t)), bisect_right(self.sizes, n * (2 - t) / t)
        if lo >= hi:
            return None
        # The shared pairs are 2 * words / 2 at most, counting only words that some template has.
        known = sum(w in self.words for w in words)
        if 2 * known < t * (n + self.sizes[lo]):
            return None
        own = bigrams(words)
        found = [(-round(d, 9), name) for name, g in self.grams[lo:hi] if (d := dice(own, g)) >= t]
        return (min(found)[1], -min(found)[0]) if found else None

    def scan(self, text: str | None) -> list[tuple[str, int, str, float]]:
        """(unit, line, template, dice): the whole text, each line of a text with several, and passages.

        A passage is left out if it overlaps a text, line or passage that shares as many pairs with its template.
        """
        if not text:
            return []
        data = text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS_BUT_LINES)
        units = [("text", 0, data)]
        if b"\n" in data:
            units += [("line", k, line) for k, line in enumerate(data.split(b"\n"), 1) if line]
        out, taken = [], []
        for unit, k, part in units:
            words = part.split(None, self.longest)  # stops beyond the largest size
            if self.shortest <= len(words) < self.longest and (hit := self.best(words)):
                out.append((unit, k, *hit))
        found = self.passages(words := data.split())
        if found:
            ends = np.cumsum([len(line.split()) for line in data.split(b"\n")])
            grams = dict(self.grams)
            for unit, k, name, d in out:
                first, last = (0, len(words)) if unit == "text" else (int(ends[k - 2]) if k > 1 else 0, int(ends[k - 1]))
                taken.append((first, last, (bigrams(words[first:last]) & grams[name]).total(), "", d))
            ordered = sorted([*taken, *found], key=lambda x: (-x[2], x[3] != "", -x[4], x[3], x[0]))
            passages = sorted(x for x in _apart(ordered, {""}) if x[3])
            out += [("passage", int(np.searchsorted(ends, first, "right")) + 1, name, d) for first, _, _, name, d in passages]
        return out


def _apart(ordered: list[tuple], free: set[str] = frozenset()) -> list[tuple]:
    """Those, in order, that overlap none before them; names in ``free`` are taken in any case."""
    out: list[tuple] = []
    starts: list[int] = []
    reach = 0
    by_start: list[tuple[int, int]] = []
    for x in ordered:
        k = bisect_left(starts, x[1])
        if x[3] in free or not any(last > x[0] for _, last in by_start[max(0, k - 1 - reach) : k]):
            out.append(x)
            starts.insert(k := bisect_left(starts, x[0]), x[0])
            by_start.insert(k, (x[0], x[1]))
            reach += x[3] in free  # only those may overlap one another
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unit, line, template, dice: a row for each unit that matches a template.

    unit is 'text' (line 0), 'line' (from 1) or 'passage' (the line it begins in). Null or empty texts match nothing; repeated rows
    are reported as often as they occur; no templates give no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *hit) for k, text in enumerate(batch.column(1).to_pylist()) for hit in held.value.scan(text)]
            ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            kinds = (pa.string(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds, 1))], ["doc_id", "unit", "line", "template", "dice"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
