"""Operators against brute-force versions on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from olapkit.llm import (hashing, lm_score, mixing, ngram_join, packing, pii, quality_knn, quality_rules, queries,
                         tokenize, topk, toxicity, warc)
from tools.oracle_check import canon

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ODD = [None, "", " \n\t ", "one", "a b c d", "A b\x0bc\fd\re", "é ü 中文\n\n x", "w " * 30_000]


def words(text):
    return (text or "").encode().translate(LOW).split()


def oracle(name, table, df):
    con = duckdb.connect()
    con.register(name, df.toArrow())
    return con


def same(df, con, sql):
    got, r = df.collect(), con.execute(sql)
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(got, df.columns) == canon(r.fetchall(), cols)
    return got


# quality rules

def brute_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = collections.defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    return len({p for v in at.values() if len(v) > 1 for k in v for p in (k, k + 1, k + 2)})


def test_quality_rules(frame):
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice(["a ", "b ", "A! ", "# ", "\n", "c|"]) for _ in range(rng.randint(0, 90)))
                   for _ in range(60)]
    docs = frame([(k // 2, t) for k, t in enumerate(texts)] + [(None, "x")])
    got = same(quality_rules.report(docs), oracle("documents", "documents", docs), quality_rules.op2_sql())
    want = sorted(brute_repeats(t) for t in [*texts, "x"])
    assert sorted(r.n_repeat_words for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.report(frame([])).count() == 0


def test_quality_policies_and_ablation(frame):
    good = " ".join(f"word{k}" for k in range(60))
    docs = frame([(1, good), (2, "few"), (3, good.replace(" ", " # ")), (4, "# " * 20), (5, None)])
    kept = quality_rules.accepted(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    led = quality_rules.ledger(docs)
    table = {r.rule: r for r in quality_rules.ablation(led).collect()}
    assert table["few_words"].failed == 3 and table["symbols"].failed == 2 and table["symbols"].rejected_alone == 1
    assert table["symbols"].kept_without == 2 and table["few_words"].documents == 5
    v1 = led.where(quality_rules.passes("v1")).collect()
    assert {r.doc_id for r in v1} == {1, 3}


def test_quality_rules_use_no_python(frame):
    from ..conftest import plan_text

    assert not re.search("EvalPython|MapIn|FlatMap|PythonUDF|InPandas", plan_text(quality_rules.report(frame([(1, "a")]))))


# hashing and near duplicates

@pytest.mark.parametrize("piece", [1 << 20, 8])
def test_word_hashes(monkeypatch, piece):
    monkeypatch.setattr(hashing, "PIECE", piece)
    rng = random.Random(1)
    texts = ODD[:7] + ["".join(rng.choice("aB \n\té") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    got, seen = dict(hashing.text_words(pa.array(texts).slice(0))), {}
    for k, t in enumerate(texts):
        own = got.get(k, [])
        assert len(own) == len(words(t))
        for w, h in zip(words(t), own):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    part = dict(hashing.text_words(pa.array(texts).slice(3, 9)))
    assert all((part.get(k, []) == got.get(k + 3, [])) if not len(part.get(k, [])) else
               (part[k] == got[k + 3]).all() for k in range(9))


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(sets[k]), None if i is None else least[root(k)]) for k, (i, _) in enumerate(rows)]


def near_copies(rng, n_groups, size, edits, length=60):
    vocab = [f"v{k}" for k in range(400)]
    passage = [rng.choice(vocab) for _ in range(30)]
    for _ in range(n_groups):
        base = [rng.choice(vocab) for _ in range(rng.randint(length // 2, length))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                k = rng.randrange(len(w))
                w[k:k + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(vocab)]])
            yield " ".join(w)


def template_pages(rng, pages, shared=200, own=30, name="t"):
    """Pages of one template whose own words keep them under the bound, and now and then a near copy of a page."""
    head = [f"{name}{k}" for k in range(shared)]
    for k in range(pages):
        page = head + [f"{name}own{rng.randrange(10 ** 9)}" for _ in range(own)]
        yield " ".join(page)
        if k % 50 == 0:
            yield " ".join(page[:-2] + ["other", "end"])


@pytest.mark.parametrize("small, voters, levels", [(9, 15, 4), (2, 15, 4), (2, 2, 2), (3, 1, 1)])
def test_ngram_join(frame, monkeypatch, small, voters, levels):
    """With a bound of 2 on small buckets nearly all goes the way of groups and differences. Which members vote and how
    many rounds there are decides on the work alone."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "CROWD", small)
    monkeypatch.setattr(ngram_join, "VOTERS", voters)
    monkeypatch.setattr(ngram_join, "LEVELS", levels)
    rng = random.Random(small)
    texts = [*near_copies(rng, 6, 25, 4), *near_copies(rng, 20, 3, 3), *near_copies(rng, 3, 12, 2, 8)]
    rows = [(k, t) for k, t in enumerate(texts + texts[:10] + ODD)]
    rng.shuffle(rows)
    rows += [(None, texts[0]), (None, None), (3, texts[3]), (3, texts[40])]
    docs = frame(rows)
    got = sorted(map(tuple, ngram_join.report(docs).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)


def test_ngram_join_of_template_pages_makes_pairs_in_proportion(frame, monkeypatch):
    """Pages of templates, also of two under one common heading, share most words and link with few others."""
    made = {}
    whole = ngram_join._group_pairs

    def counted(*args):
        pairs = whole(*args)
        made[size] = pairs.count()
        return pairs

    monkeypatch.setattr(ngram_join, "_group_pairs", counted)
    for size in (250, 1000):
        rng = random.Random(size)
        texts = [*template_pages(rng, size // 2), *template_pages(rng, size // 4, 150, 25, "u"),
                 *template_pages(rng, size // 4, 120, 17, "v")]
        rows = list(enumerate(texts))
        got = {r.doc_id: r.component_id for r in ngram_join.report(frame(rows)).collect()}
        sets = [(k, frozenset(zip(*[t.split()[i:] for i in range(5)]))) for k, t in rows]
        near = [i - 1 for i, t in rows if t.endswith(" other end")]
        assert all(got[i + 1] == i for i in near)
        if size == 250:
            assert [(k, len(s), got[k]) for k, s in sets] == brute_components(rows)
        assert sum(got[k] != k for k, _ in rows) == len(near)
    assert made[1000] <= 5 * made[250] and made[1000] <= 4 * 1000


def test_rare_shingles_add_nothing_to_the_sketch(frame, monkeypatch):
    """Cells hold the count of their most frequent shingle. A sum of a cell's shingles tells a common line from the
    others only while the corpus is small."""
    line = " ".join(f"line{k}" for k in range(300))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(1000))) for k in range(100)] + [(100 + k, line) for k in range(12)]
    want = {0: (1 << 22) - 99_600 - 296, 8: 99_600, 29: 296}  # 8 log2(1 + 1), 8 log2(1 + 12)
    for flush in (1 << 21, 5000):
        monkeypatch.setattr(ngram_join, "FLUSH", flush, raising=False)
        found = ngram_join._sketch(frame(rows).select("text"), 5)
        cells = np.bincount(found[0], minlength=256)
        assert all(abs(cells[k] - n) < 2000 for k, n in want.items())  # two of a level may share a cell
        assert cells.sum() - cells[[*want]].sum() <= 3  # and two may share a number
        mass = found[2]
        assert mass.sum() == 99_600 + 12 * 296 and abs(mass[29] - 12 * 296) < 50


def test_shingles_are_counted_whole():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)) for _ in range(4)]
    sets += [sets[0][:50]] * 70_000 + [np.array([0, 1, 2 ** 64 - 1], np.uint64)]
    got = {}
    for block, slots, repeats in zip(*(c.to_pylist() for c in ngram_join._packed(sets).columns)):
        for x, count in zip(*ngram_join._unpacked(slots, repeats)):
            got[block << ngram_join.SLOT - ngram_join.BLOCK_BITS | int(x)] = count
    x, count = np.unique(np.concatenate(sets) >> np.uint64(64 - ngram_join.SLOT), return_counts=True)
    assert got == dict(zip(x.tolist(), count.tolist())) and max(got.values()) == 70_001


def test_ngram_join_with_a_larger_sketch(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLOT_BITS", 24)
    monkeypatch.setattr(ngram_join, "FLUSH", 100)
    rng = random.Random(7)
    rows = list(enumerate([*near_copies(rng, 5, 15, 4), *near_copies(rng, 20, 3, 3), *ODD]))
    assert sorted(map(tuple, ngram_join.report(frame(rows)).collect())) == sorted(brute_components(rows))


def test_fragments_cut_the_global_order():
    levels = np.random.default_rng(1).integers(0, 90, 1 << ngram_join.SLOT_BITS).astype(np.uint8)
    codes = np.random.default_rng(2).integers(0, 2 ** 64, 200_000, dtype=np.uint64)
    # a shingle's slot counts it, so a draw by counts has about equal parts
    weight = 2.0 ** (levels[ngram_join._slots(codes)] / 8) - 1
    at = np.searchsorted(ngram_join._cuts(levels), ngram_join._order(codes, levels))
    mass = np.bincount(at, weight, ngram_join.FRAGMENTS)
    assert len(mass) == ngram_join.FRAGMENTS and mass.max() < 1.1 * mass.mean()
    assert len(ngram_join._cuts(np.zeros_like(levels))) == ngram_join.FRAGMENTS - 1


def test_ngram_join_keeps_one_of_a_group(frame):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text), (2, text + " end"), (9, "other"), (9, "other"), (None, text), (7, None), (8, "")]
    kept = ngram_join.distinct_documents(frame(rows))
    assert sorted((r.doc_id or -1, r.size) for r in kept.collect()) == [(-1, 7), (2, 7), (7, 7), (8, 7), (9, 7)]
    assert ngram_join.report(frame([])).count() == 0
    assert ngram_join.report(frame([(1, None)])).collect()[0].component_id == 1


def test_ngram_join_keeps_one_row_of_each_component(frame):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, None), (3, a), (3, a), (3, b), (3, ""), (3, ""), (4, b + " end"), (1, c), (5, c + " end"), (5, a + " end"),
            (6, "A" + a[1:]), (None, c)]
    kept = ngram_join.distinct_documents(frame(rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, None), (3, a), (3, b), (3, ""), (1, c), (None, c)], key=str)


def test_prefix_length():
    for n in range(1, 200):
        assert ngram_join.prefix_length(n) == n - math.ceil(8 * n / 10) + 1


# personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and sum(
                      sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0,
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(2)
    bits = [*"0123456789@.- +()é_%\n", "a", "b.c", "..", "x@y.z", "1.2.3.4", "4111111111111111", "+1 (988) 555-2485",
            "255.255.1.0", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("9" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def pii_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = []
    for k in range(60):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40)) + "0a"
        value = secret if k % 3 else f"Xy{k:04d}_z"  # every third has no known form
        texts.append(f"{word()} {word()} password={value} {word()} the {word()}12345 {word()}")
    return texts


def test_contexts_find_unseen_identifiers(frame):
    texts = [*pii_rows(), None, "", "call +1 (988) 555-2485 or mail a.b@c.de", "clean text of words and 2024 numbers1"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (0, texts[0])]
    docs = frame(rows)
    got = pii.report(docs).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(rows)
    for k, t in enumerate(texts):
        want = brute_spans(t or "")
        joined = ",".join(f"{a}:{b}:{c}" for a, b, c in want)
        assert by[k].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert by[k].spans == joined or by[k].spans.startswith(joined)
        if t and "password=" in t:
            at = t.index("password=") + 9
            kind = "secret" if k % 3 else "context"
            assert by[k].spans == f"{kind}:{at}:{t.index(' ', at)}"
        elif k >= 60:
            assert by[k].spans == joined
    red = {r.doc_id: r for r in pii.redact(docs).collect() if r.doc_id is not None}
    assert pii.redact(docs).columns == docs.columns
    assert "password=[CONTEXT]" in red[0].text and red[0].n_chars == len(red[0].text)
    assert red[60].text is None and red[62].text == "call [PHONE] or mail [EMAIL]" and red[63].text == texts[63]
    assert pii.report(frame([])).count() == 0


def test_contexts_at_places_equal_the_lexical_ones(monkeypatch):
    rng = random.Random(8)
    texts = ["", "x", " \n", *("".join(rng.choice(["ab", "_c", "9", "=", " ", "\n ", ":", "é", "中", "🎉", "\u3000"])
                                  for _ in range(rng.randint(0, 90))) for _ in range(80))]
    want = collections.Counter()
    for k, t in enumerate(texts):
        token = [m.span() for m in pii._LEX.finditer(t)]
        for at in range(1, len(t)):
            done = [s for s, e in token if e <= at]
            if not any(s < at < e for s, e in token):
                want.update((k, at, pii.context_hash(t[done[-n]:at])) for n in (2, 3)
                            if len(done) >= n and at - done[-n] <= pii.LEFT)
    bits = np.full(1 << pii.FILTER_BITS - 3, 255, np.uint8)
    for piece in (1 << 17, 64, 3):
        monkeypatch.setattr(pii, "PIECE", piece)
        assert collections.Counter(pii._hits(texts, bits)) == want


def test_rare_contexts_are_found_beside_many_seeds(frame):
    # 140,000 seeds of other contexts: a ten-thousandth of them is more than the six of this one
    ips = [" ".join(f"node at 10.{k % 250}.{j // 250}.{j % 250}" for j in range(2000)) for k in range(70)]
    own = pii_rows()[:9]
    rows = list(enumerate([*own, *ips]))
    by = {r.doc_id: r for r in pii.report(frame(rows)).collect()}
    for k, t in enumerate(own):
        at = t.index("password=") + 9
        assert by[k].spans == f"{'secret' if k % 3 else 'context'}:{at}:{t.index(' ', at)}"


# tokens and packing

def test_token_ids_equal_the_tokenizers_library(monkeypatch):
    enc = tokenize.Encoder(queries.vocabulary())
    rng = random.Random(4)
    bits = [" ", "  ", "\n", " \n", "\t", "a", "é", "中", "1", "!", "'s", " ", "\x1c", "　", "b c",
            "<|endoftext|>", "don't", "​", "\x85", "²", "̀", "Ⅷ", "᠎"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "  "]
    for slice_ in (1 << 19, 7):
        monkeypatch.setattr(tokenize, "SLICE", slice_)
        for t in texts:
            assert enc.encode(t).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids
    assert enc.encode(None).tolist() == []


@pytest.mark.parametrize("limits", [{}, {"max_segments": 4}, {"max_loss": 1024},
                                    {"max_tokens": 100, "max_segments": 3, "max_loss": 60}])
def test_packer_keeps_all_limits(limits):
    rng = np.random.default_rng(0)
    p, examples, out = packing.Packer(window=64, **limits), [], []
    for k in range(1500):
        n = int(rng.choice([rng.integers(0, 50), rng.integers(1, 3000), rng.integers(1, 9000)]))
        examples.append((n, int(rng.integers(0, n + 1)) if "max_loss" in limits else 0))
        out += p.add(k, *examples[-1])
    out += p.finish()
    docs, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for key, at, n, offset, loss, segment, seq in out:
        docs[key].append((at, n))
        seqs[seq].append((offset, n, loss))
        assert loss == max(0, at + n - max(at, examples[key][1])) and n > 0
    for k, (n, _) in enumerate(examples):
        at = 0
        for start, length in sorted(docs[k]):
            assert start == at
            at += length
        assert at == n
    tokens = limits.get("max_tokens", 2048)
    padding = 0
    for v in seqs.values():
        at = 0
        for offset, n, _ in sorted(v):
            assert offset == at
            at += n
        assert at <= tokens and len(v) <= limits.get("max_segments", 256)
        assert sum(x for _, _, x in v) <= limits.get("max_loss", tokens)
        padding += packing.padded_length(at, tokens) - at
    if not limits:
        assert padding == 0


def test_packing_of_documents(frame, spark):
    rows = [(k, t) for k, t in enumerate(ODD * 2)] + [(None, "null id"), (3, "one")]
    got = packing.report(frame(rows), queries.vocabulary()).collect()
    enc = tokenize.encoder(queries.vocabulary())
    want = collections.Counter()
    for i, t in rows:
        want[i, len(enc.encode(t)) + 1] += len(enc.encode(t)) + 1
    have = collections.Counter()
    for r in got:
        have[r.doc_id, r.doc_tokens] += r.length
    assert have == want
    long = [*enc.encode(ODD[7]), 1]
    for r in got:
        if r.doc_tokens == len(long):
            piece = np.array(long[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece)
    assert packing.report(frame([]), queries.vocabulary()).count() == 0
    chat = spark.createDataFrame([(1, "hi there", "answer"), (2, None, "x"), (3, "q", None)],
                                 "doc_id long, p string, text string")
    loss = {r.doc_id: r.loss_tokens for r in packing.pack(chat, queries.vocabulary(), prompt="p").collect()}
    assert loss[3] == 1 and loss[1] == len(enc.encode("answer")) + 1


# mixing

def test_mixing(frame):
    rng = random.Random(5)
    rows = [(k, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 90))),
             rng.choice(["a"] * 9 + ["b", "c", None, "", "ä", "z"])) for k in range(400)]
    rows += [(k, t, "a") for k, t in enumerate(ODD)] + [(None, "n n n", None), rows[7], rows[7], (1, None, "empty")]
    docs = frame(rows, 3)
    got = same(mixing.report(docs), oracle("documents", "documents", docs), mixing.OP10_SQL)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size, r.target] += r.taken
    for (_, target), n in taken.items():
        assert abs(n - target) <= 1.000001 * max(1, list(taken).count(target)) or n % math.floor(target) == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r.text)) for r in out.collect()) == sum(r.taken for r in got)
    assert mixing.report(frame([])).count() == 0
    assert [r.taken for r in mixing.report(frame([(1, None), (2, "")])).collect()] == [0, 0]


def test_schedule_is_even(frame):
    """In every stretch of the schedule each source has nearly its share, and every needed block is there once."""
    rows = [(k, "w " * 500, s) for k, s in enumerate("aaaabbc")]
    sized = mixing.sizes(frame(rows))
    goal = mixing.targets(sized)
    plan = [tuple(r) for r in mixing.schedule(goal, 3500 // 10, 10).orderBy("slot").collect()]
    need = {r.skey: -(-r.words // 10) for r in goal.collect()}
    for s, n in need.items():
        assert sorted(r for _, k, r in plan if k == s) == list(range(n))
    share = {s: n / sum(need.values()) for s, n in need.items()}
    for upto in range(30, 340, 10):
        for s in need:
            assert abs(sum(k == s for _, k, _ in plan[:upto]) - upto * share[s]) < 5


def test_result_comes_through_the_schedule(frame, monkeypatch):
    rows = [(k, f"w{k} " * 300, s) for k, s in enumerate("aaaaabbbbcc" * 12)]
    slots = lambda: {r.doc_id: (r.first_slot, r.last_slot) for r in mixing.report(frame(rows)).collect()}
    right, out = slots(), [(r.source, len(words(r.text))) for r in mixing.mixed(frame(rows)).collect()]
    assert all(a <= b for a, b in right.values() if a is not None)
    # in order: any stretch of the mix has the sources nearly in their shares
    total = collections.Counter()
    for s, n in out:
        total[s] += n
    every = sum(total.values())
    for at in range(20, len(out), 20):
        seen = collections.Counter()
        for s, n in out[:at]:
            seen[s] += n
        for s in total:
            assert abs(seen[s] / sum(seen.values()) - total[s] / every) < 0.2, (at, s)
    monkeypatch.setattr(mixing, "STEP", 0)
    assert slots() != right
    bad = [r.source for r in mixing.mixed(frame(rows)).collect()]
    assert len(set(bad[:len(bad) // 3])) < 3 or bad != [s for s, _ in out]


def test_mixing_many_sources(frame, monkeypatch):
    """Numbered and cumulated in parts: as with one part."""
    rows = [(k, "w " * (k % 13), f"s{k % 57:02d}") for k in range(300)]
    want = sorted((tuple(r) for r in mixing.report(frame(rows)).collect()), key=str)
    monkeypatch.setattr(mixing, "GROUP", 4)
    docs = frame(rows)
    got = same(mixing.report(docs), oracle("documents", "documents", docs), mixing.OP10_SQL)
    assert sorted((tuple(r) for r in got), key=str) == want


# classifiers

def classified_rows(n=600):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "re"]) for _ in range(rng.randint(1, 3)))
    rows, marks = [], []
    for k in range(n):
        w = [word() for _ in range(rng.randint(20, 60))]
        toxic, bad = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["idiot", "vequxo", "vequmi"])
        text = " ".join(w) if not bad else " ".join(x.upper() + "!!" for x in w)
        rows.append((k, text))
        marks.append((k, int(not bad), int(toxic)))
    return rows, marks


def test_toxicity(frame, labels, monkeypatch):
    rows, marks = classified_rows()
    marks += [(None, 1, 1), (10_000, 0, 0), (3, None, None), (4, *marks[4][1:])]
    docs = frame([*rows, *((1000 + k, t) for k, t in enumerate(ODD)), (None, "x"), rows[0]])
    got = toxicity.report(docs, labels(marks)).collect()
    assert len(got) == len(rows) + len(ODD) + 2
    by = {r.doc_id: r for r in got}
    for k, (i, _) in enumerate(rows):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    wrong = sum(by[i].predicted != marks[i][2] for i, _ in rows if by[i].held_out)
    assert wrong <= 0.05 * sum(by[i].held_out for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert by[1000].score == by[1001].score == by[1002].score and by[1000].predicted == 0
    # held-out labels are never read
    flipped = [(i, q, 1 - t) if i is not None and t is not None and zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t)
               for i, q, t in marks]
    again = toxicity.report(docs, labels(flipped)).collect()
    assert sorted((r.doc_id or -1, round(r.score, 9)) for r in again) == sorted(
        (r.doc_id or -1, round(r.score, 9)) for r in got)
    assert {r.score for r in toxicity.report(docs, labels([])).collect()} == {0.0}
    assert toxicity.report(frame([]), labels(marks)).count() == 0


def test_toxicity_learns_from_every_labelled_row_whole(frame, labels, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 5)             # the bound that op1 had
    rows, marks = classified_rows()
    seen = toxicity.labelled(frame([*rows, (None, "x")]), labels(marks), "toxic", 4, 2)
    kept = [(t, m[2]) for (i, t), m in zip(rows, marks) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted((r.text, r.label) for r in seen.collect()) == sorted(kept)
    want = collections.defaultdict(lambda: [0, 0])
    for t, y in kept:
        for w in toxicity.tokens(t):
            for g in toxicity.grams(w):
                want[g][1 - y] += 1
    monkeypatch.setattr(toxicity, "CACHE", 3)
    assert {r.gram: [r.toxic, r.ordinary] for r in toxicity.count_grams(seen).collect()} == want
    # texts of more than 20,000 characters are training texts too
    long = [(i, t + " an er th on re" * 1500) for i, t in rows]
    got = {r.doc_id: r for r in toxicity.report(frame(long), labels(marks)).collect()}
    assert sum(got[i].predicted != m[2] for (i, _), m in zip(rows, marks)) <= 0.05 * len(rows)


def test_kneser_ney_probabilities_sum_to_one():
    rng = random.Random(7)
    counts = {}
    for _ in range(200):
        for g in toxicity.grams("".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))):
            c = rng.randrange(2)
            a = list(counts.get(g, (0, 0)))
            a[c] += 1
            counts[g] = tuple(a)
    shared = toxicity._shared(counts)
    heads = collections.defaultdict(float)
    for g, p in shared.items():
        heads[g[:-1]] += p
    assert all(0 < s <= 1 + 1e-9 for s in heads.values())
    model = toxicity.Model(counts)
    assert model.word("zzz") == sum(model.unseen.get(g[:-1], 0.0) for g in toxicity.grams("zzz"))


def test_quality_neighbours(frame, labels):
    rows, marks = classified_rows()
    docs = frame([*rows, *((1000 + k, t) for k, t in enumerate(ODD)), (None, "x"), rows[0]])
    got = quality_knn.report(docs, labels([*marks, (None, 0, 0), (9999, 1, 1)])).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(ODD) + 2
    for i, _ in rows:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    wrong = sum(by[i].predicted != marks[i][1] for i, _ in rows if by[i].held_out)
    assert wrong <= 0.03 * sum(by[i].held_out for i, _ in rows)
    train = [m[1] for m in marks if zlib.crc32(str(m[0]).encode()) % 5]
    assert by[1000].score == by[1001].score == pytest.approx(sum(train) / len(train), abs=0.01)
    assert {r.score for r in quality_knn.report(docs, labels([])).collect()} == {0.5}
    assert quality_knn.report(frame([]), labels(marks)).count() == 0


def test_neighbour_votes_equal_brute_force():
    rng = np.random.default_rng(8)
    texts = pa.array([" ".join(rng.choice(["aa", "Bb!", "c|", "dd", "e#"], rng.integers(1, 30))) for _ in range(80)])
    vectors = list(quality_knn._vectors(texts))
    space = quality_knn.Space(vectors[:60], (np.arange(60) % 3 > 0).astype(int))
    got = space.scores(vectors[60:])
    for (terms, weights), score in zip(vectors[60:], got):
        x = weights @ space.basis[terms].astype(float)
        cos = space.points.astype(float) @ (x / np.linalg.norm(x))
        near = np.sort(cos)[::-1][:quality_knn.NEIGHBOURS]
        best = np.argsort(-cos)[:quality_knn.NEIGHBOURS]
        if np.sum(np.isclose(cos, near[-1], atol=1e-6)) == 1:
            want = (np.maximum(cos[best], 0) * space.labels[best]).sum() / np.maximum(cos[best], 0).sum()
            assert score == pytest.approx(want, abs=1e-4)


# language models

def brute_losses(docs, target, background, word_share, bigram_share):
    count = [collections.Counter(w for t in c for w in words(t)) for c in (target, background)]
    total = sum(sum(c.values()) for c in count)
    vocab = {w for c in count for w in c if count[0][w] + count[1][w] >= max(1, word_share * total)}
    cut = lambda t: [w if w in vocab else None for w in words(t)]
    uni, bi, ctx = ([collections.Counter(), collections.Counter()] for _ in range(3))
    for m, c in enumerate((target, background)):
        for t in map(cut, c):
            uni[m].update(t)
            bi[m].update(zip(["<s>", *t[:-1]], t))
            ctx[m].update(["<s>", *t[:-1]][:len(t)])
    n = [sum(u.values()) for u in uni]
    kept = {k for m in (0, 1) for k in bi[m] if bi[m][k] >= max(1, bigram_share * n[m])}

    def loss(m, text):
        t, s = cut(text), 0.0
        for a, b in zip(["<s>", *t[:-1]], t):
            mass = lambda x, y: max(bi[m][x, y] - 0.75, 0) / ctx[m][x] if ctx[m][x] else 0.0
            rest = 1 - sum(mass(x, y) for x, y in kept if x == a)
            u = (uni[m][b] + 0.5) / (n[m] + 0.5 * (len(vocab) + 1))
            s -= math.log((mass(a, b) if (a, b) in kept else 0) + rest * u)
        return s / len(t) if t else 0.0

    return [(loss(0, t), loss(1, t)) for t in docs]


@pytest.mark.parametrize("shares", [(1e-9, 1e-9), (0.01, 0.02)])
def test_cross_entropy_difference(frame, spark, shares):
    rng = random.Random(9)
    say = lambda v: " ".join(rng.choice(v) for _ in range(rng.randint(0, 25)))
    background = [*(say(["a", "B", "b", "c", "d", "e"]) for _ in range(30)), None, "", "A" * 5000]
    target = [say(["b", "c", "x", "y"]) for _ in range(12)] + [None]
    docs = frame([(k, t) for k, t in enumerate(background)] + [(None, "b c"), (0, background[0])])
    other = spark.createDataFrame([(t,) for t in target], "text string")
    got = lm_score.score(docs, other, docs.select("text"), word_share=shares[0], bigram_share=shares[1]).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = brute_losses([texts[r.doc_id] for r in got], target, [*background, "b c", background[0]], *shares)
    for r, (t, b) in zip(got, want):
        assert r.target_loss == pytest.approx(t) and r.background_loss == pytest.approx(b)
        assert r.score == pytest.approx(t - b) and r.n_tokens == len(words(texts[r.doc_id]))
    none = spark.createDataFrame([], "text string")
    assert lm_score.score(docs, none, none).count() == docs.count()
    assert lm_score.score(frame([]), other, none).count() == 0


def lm_case(frame, spark, long, texts, other):
    """Scores of short texts beside one long text of the background, and what brute force gives."""
    docs = frame(list(enumerate(texts)))
    background = spark.createDataFrame([(t,) for t in [*texts, long]], "text string")
    target = spark.createDataFrame([(t,) for t in other], "text string")
    got = {r.doc_id: r for r in lm_score.score(docs, target, background).collect()}
    return [(got[k].target_loss, got[k].background_loss) for k in range(len(texts))], \
        brute_losses(texts, other, [*texts, long], 0, 0)


def test_rare_words_count_in_a_large_corpus(frame, spark):
    # a word of one or two occurrences has less than 5e-5 of 60,000 words
    got, want = lm_case(frame, spark, "w " * 60_000, ["rare w words", "w w rare", "else", ""], ["rare words rare", "w of"])
    assert got == [pytest.approx(x) for x in want]


def test_chunks_and_buckets_do_not_change_scores(frame, spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "the", f"w{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 30)))
             for _ in range(60)]
    docs, other = frame(list(enumerate(texts))), spark.createDataFrame([(t,) for t in texts[:9]], "text string")
    want = brute_losses(texts, texts[:9], texts, 0, 0)
    for held in (1 << 20, 16):
        monkeypatch.setattr(lm_score, "HELD", held)
        got = {r.doc_id: r for r in lm_score.score(docs, other).collect()}
        assert len(got) == 60
        for k, (t, b) in enumerate(want):
            assert got[k].target_loss == pytest.approx(t) and got[k].background_loss == pytest.approx(b)
            assert got[k].n_tokens == len(words(texts[k]))


def test_rare_bigrams_count_in_a_large_corpus(frame, spark):
    # a bigram of one occurrence has less than 2e-6 of 1,200,000 bigrams
    got, want = lm_case(frame, spark, "w x " * 600_000, ["x x w w", "w a x", "a a"], ["x w a", "w w"])
    assert got == [pytest.approx(x) for x in want]


# search

def test_topk_equals_sql(spark):
    rng = np.random.default_rng(10)
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.3, 6)], 0) for k in rng.integers(0, 120, 260)]
    rows += [(200 + k, [0.25] * 6, 1) for k in range(30)] + [(400, None, 0), (None, [0.1] * 6, 0), (20, [0.1] * 5, 0),
             (420, [0.1, None, 0.0, 0.0, 0.0, 0.0], 0), (440, [float("nan")] * 6, 0), (460, [float("inf")] * 6, 0),
             (480, [], 0), (501, [], 0), (500, [0.5] * 5, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(4)
    same(topk.report(df), oracle("embeddings", "embeddings", df), topk.OP4_SQL)
    assert topk.report(df.limit(0)).count() == 0
    small = topk.top(topk.codes(df), group=4, block=16)
    same(small, oracle("embeddings", "embeddings", df), topk.OP4_SQL)


@pytest.mark.parametrize("size,n,d", [(3, 400, 4), (20, 300, 16), (10 ** 6, 100, 5), (2 ** 40, 50, 3)])
def test_bounds_lose_no_winner(size, n, d):
    rng = np.random.default_rng(size)
    x, ids = rng.integers(-size, size + 1, (n, d)), rng.integers(0, n // 2, n)
    got = collections.defaultdict(list)
    for i, j, s in topk.top_block(ids[::7], x[::7], ids, x, 9):
        got[i].append((-s, int(ids[j])))
    exact = x.astype(object)
    for i, q in enumerate(exact[::7]):
        best = sorted((-int(s), int(c)) for s, c in zip(exact @ q, ids) if c != ids[::7][i])
        assert got[i] == best[:9]


# archives

def test_archives(spark, tmp_dir):
    rows = [(k, f"http://h{k}.example/{k}", f"<p>{k % 7}</p>\r\n\r\n") for k in range(50)]
    rows += [(100, None, None), (101, "", ""), (None, "a b\tc\n", "x\r\n\r\ny"), (None, "q", "\r\n\r\n"),
             (102, "ü", "\r\n\r\n"), (102, "ü", "\r\n\r\n"), (5000, "z", "é" * 100_000), (4000, "z", "é" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    con = oracle("pages", "pages", pages)
    same(warc.report(pages), con, warc.OP3_SQL)
    assert warc.report(pages.limit(0)).count() == 0
    warc.write_arc(pages, f"{tmp_dir}/arc")
    arc = warc.read_arc(spark, f"{tmp_dir}/arc").collect()
    assert sorted((r.page_id or -1, r.html) for r in arc) == sorted((i or -1, h or "") for i, _, h in rows)
    warc.write_warc(warc.convert(warc.read_arc(spark, f"{tmp_dir}/arc")), f"{tmp_dir}/warc")
    back = warc.read_warc(spark, f"{tmp_dir}/warc").collect()
    assert {r.warc_date for r in back if r.page_id == 1} == {"2024-01-01T00:00:01Z"}
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", r.record_id) for r in back)


def test_broken_archives():
    import io

    head = "filedesc://x 0.0.0.0 20240101000000 text/plain {}\n{}\n"
    body = f"1 0 me\n{warc.FIELDS[1]}\n"
    good = head.format(len(body), body) + "http://a 1.2.3.4 20240101000000 text/html 3\nabc\n"
    assert [(f["URL"], f["version"], c) for f, c in warc.parse_arc(io.BytesIO(good.encode()), "f")] == [
        ("http://a", 1, b"abc")]
    for bad in (good.replace("html 3", "html 9"), good.replace("1.2.3.4 ", ""), good.replace("1 0 me", "7 0 me"),
                good.replace("filedesc", "http"), good.replace("abc\n", "abcd\n")):
        with pytest.raises(ValueError):
            list(warc.parse_arc(io.BytesIO(bad.encode()), "f"))
    assert list(warc.parse_arc(io.BytesIO(b""), "f")) == []
    with pytest.raises(ValueError):
        list(warc.parse_warc(io.BytesIO(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"), "f"))
