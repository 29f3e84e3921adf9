"""Phrase collocations and counting quotient filters."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from olapkit.llm import collocations, quotient
from tools.oracle_check import canon

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000, share=80):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[k:k + m]) for k in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand, found = {p: a for p, a in c.items() if a >= least and len(p) > 1}, []
        for p, a in cand.items():
            if any(100 * b >= share * a for q, b in cand.items() if len(q) > len(p)
                   and any(q[k:k + len(p)] == p for k in range(len(q)))):
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s)
                for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
ODD = [None, "", " \t ", ".,;", "one", "a\x0bb\fc\rd a\x1cb\xa0c é ü 中文", "A a B b " * 40, "x y. " * 200, "w " * 4000]


def texts(seed, k=60):
    rng = random.Random(seed)
    parts = ["the", "The", "of", "new", "york", "city", "hall", "é", "中文", "und", "."]
    return ODD + ["".join(rng.choice(parts) + rng.choice([" ", " ", " ", "\t", ", ", "\n"]) for _ in range(rng.randint(0, 80)))
                  for _ in range(k)]


@pytest.fixture(scope="module")
def langs(spark):
    def make(rows):
        df = spark.createDataFrame([(1, t, g, "x", 5) for g, t in rows],
                                   "doc_id long, text string, lang string, word string, n int")
        return df.repartition(3) if rows else df

    return make


def rows_of(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


def test_collocations_against_brute_force_and_sql(langs):
    rows = [([None, "en", "und", "de"][k % 4], t) for k, t in enumerate(texts(1) + texts(2))]
    want = brute(rows, 30)
    docs = langs(rows)
    got = collocations.report(docs)
    assert rows_of(got) == want and want
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    r = con.execute(collocations.op11_sql())
    assert canon(r.fetchall(), [c[0] for c in r.description]) == canon(got.collect(), got.columns)
    assert collocations.report(langs([])).count() == 0
    assert collocations.report(langs([("en", None), ("en", " . ")])).count() == 0


@pytest.mark.parametrize("chunk,cut,fan,bits", [(64, 16, 256, 26), (64, 64, 4, 26), (200, 64, 4, 9)])
def test_chunks_levels_and_small_filters_change_nothing(langs, monkeypatch, chunk, cut, fan, bits):
    for name, value in (("FAN", fan), ("RANKED", 7), ("ID_BUCKETS", 2)):
        monkeypatch.setattr(collocations, name, value)
    rows = [(["en", "fr"][k % 2], t) for k, t in enumerate(texts(3, 30))]
    assert rows_of(collocations.collocations(langs(rows), least=5, top=50, chunk=chunk, step=cut,
                                             filter_bits=bits)) == brute(rows, 5, 50)


@pytest.mark.parametrize("wide,low", [(8, 8), (17, 17), (34, 17), (64, 64), (32, 32), (40, 20), (9, 3)])
def test_quotient_filters_are_lossless(wide, low):
    rng = np.random.default_rng(wide * 100 + low)
    draw = lambda bits, n: rng.integers(0, 1 << min(bits, 63), n, dtype=np.uint64)
    left, right = draw(wide, 3000), draw(low, 3000)
    left, right = np.concatenate([left, left[:900], left[:1].repeat(400)]), np.concatenate([right, right[:900], right[:1].repeat(400)])
    a, b = quotient.permute(left, right, wide, low)
    assert int(a.max()) < 1 << wide and int(b.max()) < 1 << low
    back = quotient.restore(a, b, wide, low)
    assert (back[0] == left).all() and (back[1] == right).all()
    want = collections.Counter(zip(a.tolist(), b.tolist()))
    x, y, n = quotient.counted(a, b, None, wide, low)
    assert list(zip(x.tolist(), y.tolist())) == sorted(want) and dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == want
    parts = list(quotient.pieces(x, y, n, wide, low))
    assert len({p for p, _ in parts}) == len(parts)
    read = [quotient.unpack(f, p, wide - 8, low) for p, f in parts]
    for got, full in zip(zip(*read), (x, y, n)):
        assert (np.concatenate(got) == full).all()
    twice = [np.concatenate([v, v]) for v in (x, y, n)]
    assert (quotient.counted(*twice, wide, low)[2] == 2 * n).all()
    assert sum(len(f) for _, f in parts) < len(x) * (-(-wide // 8) + -(-low // 8) + 8)


def test_permutation_covers_all_keys():
    left, right = (v.ravel().astype(np.uint64) for v in np.meshgrid(np.arange(256), np.arange(64)))
    a, b = quotient.permute(left, right, 8, 6)
    assert len(set(zip(a.tolist(), b.tolist()))) == 256 * 64
