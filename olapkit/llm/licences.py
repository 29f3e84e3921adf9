"""Licence scan: matching statistics against a generalised suffix automaton of licence words, chained into spans.

1. All templates (licence texts and notices) and the base phrases go, word by word, into one generalised suffix
   automaton: its states stand for the word sequences that occur in any of them, with all places where they occur.
2. A text streams through it once. At every word the automaton holds the longest sequence ending there that occurs in a
   template (the matching statistics). A base phrase ends at a word where its state is on the suffix path. A match that
   the next word does not lengthen is maximal; maximal matches of ``MIN_MATCH`` words or more are kept as anchors, one
   for each place in a template.
3. Anchors of a template that follow one another, in the text and in the template, with at most ``GAP`` words between
   them on either side are chained; an overlap counts once. A chain's score is the covered share of its template's words.
   Chains of ``MIN_SCORE`` or more give spans. Of spans that overlap in a text, that with the most covered words stays
   (then the higher score, then the label, then the earlier one), so a notice gets one licence and not all similar ones.

The automaton is made of the templates (some 1,500 words) and goes to the tasks with the function. A text is read in
slices of ``SLICE`` bytes; what is kept of it are its anchors. An anchor looks back over ``GAP`` words only.

Defined results: a null or empty text, or one without words, has no words, labels '' and score 0. The score is that of
the best chain, whether it became a span or not. Repeated rows and null ids are scanned like other rows; an empty table
gives no rows. Only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_MATCH, GAP, MIN_SCORE = 4, 30, 0.6
SLICE = 1 << 20

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, licence text or notice), public texts without their copyright lines.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details."""),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details. You should have received a copy of the GNU General Public License along with this program. If
not, see <https://www.gnu.org/licenses/>."""),
    ("lgpl-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
your option) any later version."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
]

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "score double, spans array<struct<label: string, start: long, end: long, covered: long, score: double>>")

#: Other ASCII than digits and letters separates words; A-Z are lower-cased.
_CLEAN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words(text: str | None) -> list[bytes]:
    """The words of a text: runs of digits, letters and all characters above U+007F, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN).split()


def _slices(text: str) -> Iterator[str]:
    """A text in slices of some ``SLICE`` characters that end behind a separator."""
    gap, at = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 0
    while len(text) - at > SLICE:
        m = gap.search(text, at + SLICE)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


class Automaton:
    """Generalised suffix automaton over sequences of words. State 0 is the empty sequence."""

    def __init__(self, templates: Iterable[list[bytes]], phrases: Iterable[list[bytes]] = ()):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ids: dict[bytes, int] = {}
        self.lengths: list[int] = []
        ends: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(templates):
            last = 0
            self.lengths.append(len(template))
            for k, w in enumerate(template):
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                ends.setdefault(last, []).append((t, k + 1))
        tips = [self._read(p) for p in phrases]
        #: places[state]: (template, end) of every occurrence; found[state]: (phrase, its length) that may end there
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state, own in ends.items():
            while state > 0:
                self.places[state] += own
                state = self.link[state]
        self.found: dict[int, list[tuple[int, int]]] = {}
        for state in range(1, len(self.next)):
            v, own = state, []
            while v > 0:
                own += [(p, n) for p, (tip, n) in enumerate(tips) if tip == v]
                v = self.link[v]
            if own:
                self.found[state] = own

    def _read(self, phrase: list[bytes]) -> tuple[int, int]:
        last = 0
        for w in phrase:
            last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
        return last, len(phrase)

    def _clone(self, p: int, w: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, w: int) -> int:
        """The state of ``last``'s sequence followed by ``w``."""
        q = self.next[last].get(w)
        if q is not None:  # an earlier template holds it
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, w, q)
        new, p = len(self.next), last
        self.next.append({})
        self.size.append(self.size[last] + 1)
        self.link.append(0)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._clone(p, w, q)
        return new


class Scan:
    """One text's pass through an automaton: ``feed`` its words in order, then ``finish``."""

    def __init__(self, automaton: Automaton, min_match: int = MIN_MATCH):
        self.a, self.min_match = automaton, min_match
        self.state = self.length = self.at = 0
        self.bases: list[tuple[int, int]] = []  # (phrase, start)
        self.matches: list[tuple[int, int, int]] = []  # (end, length, state) of maximal matches

    def feed(self, texts: list[bytes]) -> None:
        a, get, enough = self.a, self.a.ids.get, self.min_match
        follow, link, size, found = a.next, a.link, a.size, a.found
        v, n, at = self.state, self.length, self.at
        for w in map(get, texts):
            at += 1
            if w is None:
                if n:
                    if n >= enough:
                        self.matches.append((at - 1, n, v))
                    v = n = 0
                continue
            if w not in follow[v]:
                if n >= enough:
                    self.matches.append((at - 1, n, v))
                while v > 0 and w not in follow[v]:
                    v = link[v]
                n = size[v]
                if w not in follow[v]:
                    continue
            v, n = follow[v][w], n + 1
            if v in found:
                self.bases += [(p, at - k) for p, k in found[v] if n >= k]
        self.state, self.length, self.at = v, n, at

    def finish(self) -> None:
        if self.length >= self.min_match:
            self.matches.append((self.at, self.length, self.state))
        self.length = self.state = 0


def chains(a: Automaton, matches: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int, int]]:
    """(template, start, end, covered words) of the best chain that ends with each anchor."""
    recent: dict[int, deque] = {}
    out: list[tuple[int, int, int, int]] = []
    for end, n, state in matches:  # in order of their ends, and so of their starts
        for t, to in a.places[state]:
            window = recent.setdefault(t, deque())
            while window and window[0][0] < end - n - gap:
                window.popleft()
            best = (n, end - n)
            for o_end, o_to, covered, start in window:
                over = max(0, o_end - (end - n), o_to - (to - n))
                if over < n and o_end < end and (to - n) - o_to <= gap and covered + n - over > best[0]:
                    best = (covered + n - over, start)
            window.append((end, to, *best))
            out.append((t, best[1], end, best[0]))
    return out


def chosen(found: list[tuple[int, int, int, int]], labels: list[str], lengths: list[int],
           min_score: float = MIN_SCORE) -> list[tuple[str, int, int, int, float]]:
    """Spans (label, start, end, covered, score) that do not overlap, in text order."""
    good = [(covered, min(1.0, covered / lengths[t]), labels[t], start, end) for t, start, end, covered in found
            if covered >= min_score * lengths[t]]
    taken: list[tuple[str, int, int, int, float]] = []
    good.sort(key=lambda x: (x[3], x[4]))
    at = 0
    while at < len(good):  # spans that reach into one another are judged together
        to, end = at, good[at][4]
        while to < len(good) and good[to][3] < end:
            end, to = max(end, good[to][4]), to + 1
        mine: list[tuple[str, int, int, int, float]] = []
        for covered, score, label, start, stop in sorted(good[at:to], key=lambda x: (-x[0], -x[1], x[2], x[3], x[4])):
            if all(stop <= s or start >= e for _, s, e, _, _ in mine):
                mine.append((label, start, stop, covered, score))
        taken += sorted(mine, key=lambda x: x[1])
        at = to
    return taken


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         min_match: int = MIN_MATCH, gap: int = GAP, min_score: float = MIN_SCORE, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Per row: words, base places and their labels, the best chain's score, and all spans (see ``SCHEMA``; places
    count words from 0)."""
    labels, bases = [label for label, _ in templates], list(phrases.values())
    automaton = Automaton([words(t) for _, t in templates], [words(p) for p in phrases])
    names = [f.split()[0] for f in re.split(r", (?![^<]*>)", SCHEMA)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1)):
                s = Scan(automaton, min_match)
                for part in _slices(body.as_py() or ""):
                    s.feed(words(part))
                s.finish()
                found = chains(automaton, s.matches, gap)
                spans = chosen(found, labels, automaton.lengths, min_score)
                places = [at for _, at in s.bases]
                out.append((doc_id, s.at, len(places), min(places, default=None), max(places, default=None),
                            sorted({bases[p] for p, _ in s.bases}),
                            max((min(1.0, n / automaton.lengths[t]) for t, _, _, n in found), default=0.0),
                            [dict(zip(("label", "start", "end", "covered", "score"), x)) for x in spans]))
            if out:
                span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("covered", pa.int64()), ("score", pa.float64())])
                types = [pa.int64()] * 5 + [pa.list_(pa.string()), pa.float64(), pa.list_(span)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    """Per document: base places and labels, labels with the method's, the best chain's score, and the spans."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels").alias("base_labels"),
        joined(F.concat("base_labels", F.transform("spans", lambda s: s["label"]))).alias("labels"), "score", "spans")
