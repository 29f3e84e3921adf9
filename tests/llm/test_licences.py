"""Licence scan against a brute-force version without automaton, slices or windows."""

import random
import re

import pytest

from olapkit.llm import licences

BASES = list(licences.PHRASES.items())


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, templates, min_match=licences.MIN_MATCH, gap=licences.GAP, min_score=licences.MIN_SCORE):
    w, ts = brute_words(text), [brute_words(t) for _, t in templates]
    phrases = [brute_words(p) for p, _ in BASES]
    known = {tuple(t[i:j]) for t in [*ts, *phrases] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    bases = [(label, k) for p, (_, label) in zip(phrases, BASES) for k in range(len(w)) if w[k:k + len(p)] == p]
    longest = []
    for end in range(1, len(w) + 1):
        n = 0
        while n < end and tuple(w[end - n - 1:end]) in known:
            n += 1
        longest.append(n)
    anchors = []
    for k, n in enumerate(longest):
        if n >= min_match and (k + 1 == len(longest) or longest[k + 1] != n + 1):
            part = w[k + 1 - n:k + 1]
            anchors += [(t, k + 1, n, j + n) for t, words in enumerate(ts) for j in range(len(words) - n + 1)
                        if words[j:j + n] == part]
    best = []
    for t, end, n, to in anchors:
        top, start = n, end - n
        for (o, o_end, _, o_to), (o_top, o_start) in zip(anchors, best):
            over = max(0, o_end - (end - n), o_to - (to - n))
            if (o == t and o_end < end and over < n and o_top + n - over > top and (to - n) - o_to <= gap
                    and (end - n) - o_end <= gap):
                top, start = o_top + n - over, o_start
        best.append((top, start))
    score = max((min(1.0, top / len(ts[t])) for (t, *_), (top, _) in zip(anchors, best)), default=0.0)
    good = {(-top, -min(1.0, top / len(ts[t])), templates[t][0], start, end)
            for (t, end, _, _), (top, start) in zip(anchors, best) if top >= min_score * len(ts[t])}
    spans = []
    for top, s, label, start, end in sorted(good):
        if all(end <= x[1] or start >= x[2] for x in spans):
            spans.append((label, start, end, -top, -s))
    return len(w), sorted(bases), score, sorted(spans, key=lambda x: x[1])


def check(df, rows, templates):
    got = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, sorted(rows, key=lambda x: (x[0] is None, x[0]))):
        n, bases, score, spans = brute(text, templates)
        places, base = [k for _, k in bases], {label for label, _ in bases}
        assert (r.doc_id, r.n_words, r.n_base) == (doc_id, n, len(bases)), text
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert [(s.label, s.start, s.end, s.covered, s.score) for s in r.spans] == spans, text
        assert r.score == score and 0 <= r.score <= 1
        if "labels" in r:
            assert r.base_labels == ",".join(sorted(base))
            assert r.labels == ",".join(sorted(base | {s[0] for s in spans}))


def test_slices_keep_words(monkeypatch):
    monkeypatch.setattr(licences, "SLICE", 8)
    for t in ["", "abc", "x" * 30 + " y", "Some words, é中文 and_more -- of 12.5 them " * 9, "no" * 40]:
        parts = list(licences._slices(t))
        assert "".join(parts) == t and [w for p in parts for w in licences.words(p)] == licences.words(t)
    assert len(parts) == 1 and len(list(licences._slices("a b " * 99))) > 20


def test_licences_against_brute_force(frame):
    rng = random.Random(13)
    full = [t for _, t in licences.TEMPLATES]
    rows = [(k, t) for k, t in enumerate([None, "", " \n.,- ", "one", "mit license", "The MIT\n License; é中文 GPL_License",
                                          "general public license " * 40, "x" * 70_000, *full])]
    for k in range(60):
        words = rng.choice(full).split()
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randint(0, 3)] = rng.choice([[], ["Foo"], ["the", "License"], ["Ünï"] * 35, words[:9]])
        other = rng.choice(full).split()
        rows.append((1000 + k, " ".join(["intro"] * rng.randint(0, 3) + words + other[rng.randint(0, 9):])))
    rows.append((None, "Licensed under the apache license."))
    check(licences.report(frame(rows)), rows, licences.TEMPLATES)


def test_licences_own_templates_overlaps_and_repeats(frame):
    templates = [("p", "a b c d e f g"), ("q", "c d e f x y"), ("r", "a b a b a b a b"), ("p", "a b c d z z f g")]
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("aabbcdefgxyz") for _ in range(rng.randint(0, 60)))) for k in range(300)]
    rows += [(300, "a b c d e f g a b c d e f g"), (301, "a b " * 50), (302, "a b c d q e f g")]
    check(licences.scan(frame(rows), templates), rows, templates)


def test_licences_labels(frame):
    rows = [(1, "Released under the MIT License."), (2, "x\nLicensed under CC BY-NC 4.0.\ny"), (3, "an apache license joke"),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "nothing here")]
    got = {r.doc_id: (r.base_labels, r.labels) for r in licences.report(frame(rows + rows[:1])).collect()}
    assert got == {1: ("mit", "mit"), 2: ("", "cc-by-nc-4.0"), 3: ("apache", "apache"), 4: ("gpl", "gpl,gpl-3.0"), 5: ("", "")}
    assert licences.report(frame([])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_automaton_holds_exactly_the_factors(seed):
    rng = random.Random(seed)
    seqs = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 12))] for _ in range(6)]
    a = licences.Automaton(seqs)
    factors = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for f in factors | {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(5)) for _ in range(200)}:
        v = 0
        for w in f:
            v = a.next[v].get(a.ids.get(w)) if v is not None else None
        assert (v is not None) == (f in factors)
        if v:
            want = sorted((t, j + len(f)) for t, s in enumerate(seqs) for j in range(len(s) - len(f) + 1)
                          if tuple(s[j:j + len(f)]) == f)
            assert sorted(a.places[v]) == want
