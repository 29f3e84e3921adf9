"""Token alignment against a brute-force version that encodes whole texts and compares ends of tokens one by one."""

import collections
import hashlib
import random

import numpy as np
import pytest

from olapkit.llm import alignment, queries
from olapkit.llm.tokenize import PRINTABLE

from ..conftest import SF_SMALL

ODD = [None, "", " ", "  ", "a", " a", "a ", "  a  b \n", "\n\tq", "x<|endoftext|>y <s> </s><unk>", "a▁b c", "▁", "naïve Ça 中文中文 🎉🎊 \x00 \x1c\x85 x",
       "w " * 3000, "            indent\n\n    more   ", "'s it's don't", "a　b\xa0c", "x" * 4000, "é" * 50 + " " * 50 + "🎉" * 30, "0123456789" * 20]


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts, a, b):
    others = [x for x in range(256) if x not in set(PRINTABLE)]
    byte = {chr(x): x for x in PRINTABLE} | {chr(256 + k): x for k, x in enumerate(others)}
    docs, counts = [], collections.Counter()
    for t in texts:
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(byte[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else
                   b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        raw = (" " + t).encode() if t else b""
        if not t or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            docs.append((0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        cuts, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for c in cuts:
            k, m = ends_a.index(c, i) + 1, ends_b.index(c, j) + 1
            groups.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        pairs = [(x, y) for xs, ys in groups for x in xs for y in ys]
        spelt = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        docs.append((len(ids_a), len(ids_b), (len(groups), pairs), hashlib.sha256(spelt.encode()).hexdigest()))
        counts.update(set(pairs))
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for n_a, n_b, found, sha in docs:
        n_groups, pairs = found or (0, [])
        out.append((n_a, n_b, n_groups, len(pairs), sum(counts[p] == best[p[0]] for p in pairs),
                    sum(counts[p] for p in pairs), sha))
    return out


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(df, rows, both):
    want = sorted(zip([str(r[0]) for r in rows], brute([r[1] for r in rows], *both)))
    got = sorted((str(r.doc_id), tuple(r[c] for c in COLS)) for r in df.collect())
    assert got == want


def _report(df):
    import public_tokenizers as p

    return alignment.report(df, p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("heavy", [1 << 18, 40, 1])
def test_alignment_against_brute_force(frame, both, monkeypatch, heavy):
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    rng = random.Random(5)
    parts = ["the", " the", "Hello", "world,", "\n", "  ", " ", "naïve", "中文", "🎉", "x1y2", "...", "<s>", "unbelievably"]
    texts = ODD + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    rows = [(k // 2, t) for k, t in enumerate(texts)] + [(None, "the the"), (None, None)]
    same(_report(frame(rows, 3)), rows, both)
    assert _report(frame([])).count() == 0


def test_alignment_forgets_and_expands(both, monkeypatch):
    import public_tokenizers as p

    texts = [t for t in ODD * 2] + [f"word{k % 7} and more{k} ..." for k in range(60)]
    make = lambda: alignment.Aligner(p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model"))
    want = [(*x[:5], x[5].tolist(), x[6].tolist()) for x in make().documents(texts)]
    for name, value in (("CACHE", 5), ("STEP", 40), ("PLAIN", 1)):
        monkeypatch.setattr(alignment, name, value)
        assert [(*x[:5], x[5].tolist(), x[6].tolist()) for x in make().documents(texts)] == want
    whole = make()
    whole.whole = True
    assert [(*x[:5], x[5].tolist(), x[6].tolist()) for x in whole.documents(texts)] == want


def test_coalesce():
    a, b, n = alignment.coalesce(np.array([2, 1, 4, 1]), np.array([1, 2, 3, 2]))
    assert (a.tolist(), b.tolist(), n) == ([0, 0, 1, 1], [0, 0, 1, 1], 2)
    a, b, n = alignment.coalesce(np.empty(0, np.int64), np.empty(0, np.int64))
    assert (len(a), len(b), n) == (0, 0, 0)


def test_query_on_the_smallest_table(spark, both):
    df = queries.QUERIES["op12_token_alignment"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    same(df, [(r.doc_id, r.text) for r in docs], both)
