"""Personal data: fixed kinds, and bootstrapped contextual extraction of identifiers that have no fixed form.

1. Seeds are the entities of known form: the four base kinds (email, ip, card, phone) and secrets (cloud key ids, hex
   strings). Each seed induces lexical patterns: the two and three lexical tokens in front of it, as written.
2. Patterns with enough different seeds behind them are looked for in all texts. What follows is an instance if it has
   an identifier's shape; the other occurrences count against the pattern. This is done once: instances found by
   patterns do not induce patterns of their own.
3. Spark scores the pattern-instance graph iteratively: a pattern's confidence is the trusted share of its occurrences,
   an instance is trusted as far as its patterns are (noisy or), seeds fully.
4. What follows the confident patterns is added, wherever it is not inside a known entity.

A pattern needs ``MIN_SUPPORT`` different seeds and ``CONFIDENCE``, whatever the size of the corpus. Patterns are 64-bit
hashes of their text. Every place of a text where they can end is hashed at once (numpy); places that pass a filter of
fixed size meet the patterns in a join, so patterns and instances are joined and aggregated by hash and not collected.
Only the hashes of the confident patterns are (8 bytes each, fewer than ``2 / MIN_SUPPORT`` of the seed occurrences).

Defined results: null text is empty and has no spans. Null ids, repeated rows and ties keep one row each. Empty tables
give empty results. Texts are scanned whole, in time linear in their length. Columns other than id and text are kept
out (``report``) or passed through (``redact``).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hashing import _K1, _power_tables, mix

KINDS = ("email", "ip", "card", "phone")
SECRET, CONTEXT = "secret", "context"
MIN_SUPPORT, CONFIDENCE, ROUNDS, LEFT = 5, 0.8, 3, 48
#: Bits of the filter of patterns (fixed; when it is full it lets all pass, and the join decides), and characters hashed
#: at a time.
FILTER_BITS, PIECE = 26, 1 << 17

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_VALUE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_REGION = re.compile(r"[0-9+][0-9.()\x20-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEED = re.compile(r"AKIA[0-9A-Z]{16}|(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,}")
_LEX = re.compile(r"\w+|[^\w\s]")
_SHAPE = re.compile(r"[A-Za-z0-9_-]{6,}")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain. Every start in the run of local characters before an ``@``
    leads to the same domain, so the run's first one decides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, nxt = at, at + 1
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = nxt = m.end()
        at = text.find("@", nxt)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind as listed, then start. The numeric kinds lie inside runs of
    digits, signs and blanks, which are found first."""
    found: dict[str, list] = {k: [] for k in KINDS}
    found["email"] = list(_emails(text))
    for r in _REGION.finditer(text):
        s, e = r.span()
        if e - s < 7:
            continue
        for m in _IP.finditer(text, s, e):
            if all(map(_octet, m[0].split("."))):
                found["ip"].append(m.span())
        for m in _CARD.finditer(text, s, e):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
        if text[s] == "+" and (m := _PHONE.match(text, s, e)) and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found["phone"].append(m.span())
    return [(k, s, e) for k in KINDS for s, e in found[k]]


class _Taken:
    """Spans by place, to ask for overlaps."""

    def __init__(self, spans):
        self.spans = sorted((s, e) for _, s, e in spans)
        self.top, most = [], 0
        for _, e in self.spans:
            most = max(most, e)
            self.top.append(most)

    def hit(self, start: int, end: int) -> bool:
        k = bisect_right(self.spans, (end - 1, math.inf))
        return k > 0 and self.top[k - 1] > start


def seed_spans(text: str, base: list) -> list[tuple[str, int, int]]:
    """Secrets of known form: whole runs of value characters around a digit that are a key id or a hex string."""
    taken, out, done = _Taken(base), [], 0
    for r in _REGION.finditer(text):
        s = r.start()
        if s < done or text[s] == "+":
            continue
        e = s
        while s > done and text[s - 1] in _VALUE:
            s -= 1
        while e < len(text) and text[e] in _VALUE:
            e += 1
        done = e
        if e - s >= 16 and _SEED.fullmatch(text, s, e) and not taken.hit(s, e):
            out.append((SECRET, s, e))
    return out


def contexts(text: str, start: int) -> list[str]:
    """The text of the last two and three lexical tokens in front of a place (with what stands between)."""
    begin = max(0, start - LEFT)
    at = [m.start() for m in _LEX.finditer(text, begin, start)]
    if begin and at and at[0] == begin:
        at = at[1:]  # may be cut
    return [text[at[-n]:start] for n in (2, 3) if len(at) >= n]


_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """0 for blanks, 1 for word characters, 2 for others, by code point, as in ``_LEX``."""
    if not _CLASSES:
        table, every = np.full(0x110000, 2, np.uint8), "".join(map(chr, range(0x110000)))
        for value, pattern in ((0, r"\s+"), (1, r"\w+")):
            for m in re.finditer(pattern, every):
                table[m.start():m.end()] = value
        _CLASSES.append(table)
    return _CLASSES[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def context_hash(pattern: str) -> int:
    """The hash of a context's text, as ``_piece`` has it."""
    c = _codes(pattern).astype(np.uint64) + np.uint64(1)
    h = mix((c * _power_tables(len(c))[0][:len(c)]).sum(keepdims=True) + np.array([len(c)], np.uint64) * _K1)
    return int(h.view(np.int64)[0])


def _piece(text: str, begins: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the last two and three tokens in front of every place from ``first`` on that is not inside a
    word nor at the end. ``begins``: where texts begin; no context goes beyond that, or over ``LEFT`` characters."""
    c = _codes(text)
    kind = _classes()[c]
    cut = np.zeros(len(c), bool)
    cut[begins] = True
    inside = np.concatenate([[False], (kind[1:] == 1) & (kind[:-1] == 1)]) & ~cut
    start = (kind > 0) & ~inside
    starts, upto = np.flatnonzero(start), np.cumsum(start)
    at = np.flatnonzero(~inside & ~cut)
    at = at[at >= max(first, 1)]
    before, least = upto[at - 1], np.maximum(begins[np.searchsorted(begins, at, "right") - 1], at - LEFT)
    up, down = _power_tables(len(c))
    sums = np.zeros(len(c) + 1, np.uint64)
    np.cumsum((c.astype(np.uint64) + np.uint64(1)) * up[:len(c)], out=sums[1:])
    places, hashes = [], []
    for n in (2, 3):
        s = starts[np.maximum(before - n, 0)] if len(starts) else np.zeros(len(at), np.int64)
        ok = (before >= n) & (s >= least)
        s, e = s[ok], at[ok]
        places.append(e)
        hashes.append(mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _K1))
    return np.concatenate(places), np.concatenate(hashes)


def _passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _hits(texts: list[str], bits: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, place, hash) of the contexts that pass the filter. Short texts are hashed together, long ones in pieces."""

    def found(text, begins, first):
        place, hashes = _piece(text, begins, first)
        ok = _passing(bits, hashes)
        return place[ok], hashes[ok].view(np.int64)

    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and size + len(texts[end]) <= PIECE:
            size += len(texts[end])
            end += 1
        if end > row:
            lengths = np.array([len(t) for t in texts[row:end]])
            begins = np.cumsum(lengths) - lengths
            if size:
                place, hashes = found("".join(texts[row:end]), np.unique(begins[lengths > 0]), 0)
                full = np.flatnonzero(lengths)
                own = full[np.searchsorted(begins[full], place, "right") - 1]
                yield from zip((own + row).tolist(), (place - begins[own]).tolist(), hashes.tolist())
            row = end
        else:
            for at in range(0, len(texts[row]), PIECE):
                # what lies LEFT characters back, and whether a word begins there, is in the margin
                margin = min(at, LEFT + 2)
                piece = texts[row][at - margin:at + PIECE]
                place, hashes = found(piece, np.array([0]), margin)
                yield from zip([row] * len(place), (place + at - margin).tolist(), hashes.tolist())
            row += 1


def _bits(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    slot = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    np.bitwise_or.at(bits, (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
    return bits


def _filter(patterns: DataFrame) -> np.ndarray:
    """The filter's bits: at most ``2^(FILTER_BITS - 3)`` bytes whatever the number of patterns."""
    slot = patterns.select(F.shiftrightunsigned("pattern", 64 - FILTER_BITS).alias("slot"))
    got = slot.selectExpr("slot div 8 AS at", "shiftleft(1, cast(slot % 8 AS int)) AS bit").groupBy("at").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    bits[got.column(0).to_numpy().astype(np.int64)] = got.column(1).to_numpy().astype(np.uint8)
    return bits


def _follower(text: str, at: int) -> int:
    """The end of the identifier at a place; the place itself if what follows has no identifier's shape."""
    m = _SHAPE.match(text, at)
    return m.end() if m and any(c.isdigit() for c in m[0]) else at


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    for x in batch.column(column):
        yield x.as_py() or ""


def _flush(counts: Counter, names: list[str], types: list) -> pa.RecordBatch:
    rows = [(*k, n) for k, n in counts.items()]
    counts.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _induced(docs: DataFrame) -> DataFrame:
    """(pattern, instance, n): the contexts of all seeds."""
    names, types = ["pattern", "instance", "n"], [pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for text in _texts(b, 0):
                base = base_spans(text)
                for _, s, e in base + seed_spans(text, base):
                    value = _hash(text[s:e])
                    counts.update((context_hash(p), value) for p in contexts(text, s))
                if len(counts) > 50_000:
                    yield _flush(counts, names, types)
        if counts:
            yield _flush(counts, names, types)

    return docs.mapInArrow(run, "pattern long, instance long, n long")


def _edges(docs: DataFrame, bits) -> DataFrame:
    """(pattern, instance or null, whether the instance is a seed, n) over all occurrences of what passes the filter."""
    names = ["pattern", "instance", "seed", "n"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]

    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            texts, now, taken = list(_texts(b, 0)), None, set()
            for row, at, pattern in _hits(texts, bits.value):
                text = texts[row]
                if row != now:
                    now, base = row, base_spans(text)
                    taken = {s for _, s, _ in base + seed_spans(text, base)}
                end = _follower(text, at)
                counts[pattern, _hash(text[at:end]) if end > at else None, at in taken] += 1
                if len(counts) > 50_000:
                    yield _flush(counts, names, types)
        if counts:
            yield _flush(counts, names, types)

    return docs.mapInArrow(run, "pattern long, instance long, seed boolean, n long")


def learn(docs: DataFrame, min_support: int = MIN_SUPPORT, confidence: float = CONFIDENCE,
          rounds: int = ROUNDS) -> np.ndarray:
    """The sorted hashes of the confident patterns over all rows of ``docs`` (one column: text). Patterns are induced
    once, from the seeds; the rounds score them."""
    induced = _induced(docs).groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    patterns = stored(induced.groupBy("pattern").agg(F.count("*").alias("different")).where(
        F.col("different") >= min_support).select("pattern"), "pii-patterns")
    bits = _filter(patterns)
    if not bits.any():
        return np.empty(0, np.int64)
    found = _edges(docs, docs.sparkSession.sparkContext.broadcast(bits)).groupBy("pattern", "instance", "seed").agg(
        F.sum("n").alias("n"))
    edges = stored(found.join(patterns, "pattern", "left_semi"), "pii-edges")
    seen = edges.groupBy("pattern").agg(F.sum("n").alias("seen"))
    trusted = edges.withColumn("trust", F.col("seed").cast("double"))
    for _ in range(rounds):
        conf = trusted.groupBy("pattern").agg(F.sum(F.col("n") * F.col("trust")).alias("good")).join(seen, "pattern")
        conf = conf.select("pattern", (F.col("good") / F.col("seen")).alias("conf"))
        linked = edges.join(conf, "pattern")
        doubt = linked.where("instance IS NOT NULL AND NOT seed").groupBy("instance").agg(
            F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("conf"))))).alias("doubt"))
        trusted = stored(edges.join(doubt, "instance", "left").select(
            "pattern", "instance", "seed", "n", F.when(F.col("seed"), 1.0).when(F.col("instance").isNull(), 0.0)
            .otherwise(1 - F.coalesce("doubt", F.lit(1.0))).alias("trust")), "pii-trust")
    good = trusted.groupBy("pattern").agg((F.sum(F.col("n") * F.col("trust")) / F.sum("n")).alias("conf"))
    return np.sort(good.where(F.col("conf") >= confidence).select("pattern").toArrow().column(0).to_numpy().astype(np.int64))


def _added(texts: list[str], patterns: np.ndarray, bits: np.ndarray) -> dict[int, set[tuple[int, int]]]:
    """Row -> the places of what follows confident patterns."""
    out: dict[int, set[tuple[int, int]]] = {}
    hits = list(_hits(texts, bits)) if len(patterns) else []
    known = np.isin([h for _, _, h in hits], patterns) if hits else ()
    for (row, at, _), ok in zip(hits, known):
        if ok and (end := _follower(texts[row], at)) > at:
            out.setdefault(row, set()).add((at, end))
    return out


def all_spans(text: str, follow: set[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Base spans, known secrets, then what the confident patterns add (``follow``)."""
    base = base_spans(text)
    seeds = seed_spans(text, base)
    taken, added, done = _Taken(base + seeds), [], 0
    for s, e in sorted(follow):
        if s >= done and not taken.hit(s, e):
            added.append((CONTEXT, s, e))
            done = e
    return base + seeds + added


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the counts of the base kinds, the digest of the base spans, and all spans."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    patterns = docs.sparkSession.sparkContext.broadcast(learn(own.select("text")))

    def run(batches):
        bits = _bits(patterns.value)
        for b in batches:
            rows, texts = [], list(_texts(b, 1))
            follow = _added(texts, patterns.value, bits)
            for row, t in enumerate(texts):
                spans = all_spans(t, follow.get(row, set()))
                base = [x for x in spans if x[0] in KINDS]
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return own.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                               "base_sha256 string, spans string")


def masked(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans one replacement stands for all,
    named by the first."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every found span masked and the column of the text's length renewed. Null texts stay null."""
    patterns = docs.sparkSession.sparkContext.broadcast(learn(docs.select(F.col(text).alias("text"))))
    at, size = docs.columns.index(text), docs.columns.index(length) if length else None

    def run(batches):
        bits = _bits(patterns.value)
        for b in batches:
            follow = _added(list(_texts(b, at)), patterns.value, bits)
            new = [None if t is None else masked(t, all_spans(t, follow.get(row, set())))
                   for row, t in enumerate(b.column(at).to_pylist())]
            cols = list(b.columns)
            cols[at] = pa.array(new, cols[at].type)
            if size is not None:
                cols[size] = pa.array([old if t is None else len(t) for t, old in zip(new, cols[size].to_pylist())],
                                      cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
