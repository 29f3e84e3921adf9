"""Alignment of two tokenizers' tokens by interval coalescing, and how often their ids are linked in a corpus.

A text with a space in front is encoded by a byte-level BPE (A) and by a sentencepiece model (B, which adds the space
itself). Every token covers a range of the text's bytes.

1. Both vocabularies always split in front of a single space between non-blanks, so texts are cut there into units. The
   units of a batch that the worker has not met are encoded once, whole; a model whose pieces cross such a place gets
   texts whole instead.
2. Coalescing, for all new units at once: tokens of A and B are lexsorted by start, ``maximum.accumulate`` gives the
   furthest end so far, and a group begins where a start reaches it. Within a group every A token is linked to every B
   token; the links of large groups are expanded over distinct ids.
3. A document is put together from its units: counts, the groups in words of ids (hashed), and its distinct id pairs.
4. How many documents hold a pair is counted over all documents, combined in the tasks before the shuffle. A pair is best
   if no pair of its A id has a higher count.
5. Pairs in at least 1 / 2^18 of all (document, pair) cases are at most 2^18; their counts go to the tasks as sorted
   arrays, so that frequent pairs are never join keys. All other pairs are joined with their counts by pair.

Defined results: a null or empty text, or one whose tokens' joined bytes are not those of the text (as with U+2581, which
the model reads as a space), has no tokens: zeros and ''. Special tokens' strings are plain text. Rows with equal or null
ids are documents of their own; an empty table gives no rows. Only the id and text columns are read. Memory of a task: a
text with its tokens and distinct pairs, some ``CACHE`` units, ``STEP`` characters of texts, ``FLUSH`` pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokenize import PRINTABLE, Encoder

#: Units a worker remembers; characters of texts it aligns at a time; pairs it returns at a time.
CACHE, STEP, FLUSH = 1 << 18, 1 << 21, 1 << 20
#: Links of a group up to which they are expanded one by one.
PLAIN = 1 << 12
#: Pairs in 1 / HEAVY of all cases or more are looked up in the tasks: HEAVY such pairs at most.
HEAVY = 1 << 18
_CUT = re.compile(r"(?<=\S)(?= \S)")
_ODD = re.compile(r"^\s| \s|[^\S ] | $|^$")
_CROSSING = re.compile("[^▁]▁")
SIDE = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, "
          "times array<long>")


class PlainEncoder(Encoder):
    """A's ids, with special tokens' strings taken as plain text."""

    def _exact(self, text: str) -> np.ndarray:
        self.tokenizer.encode_special_tokens = True
        return super()._exact(text)

    def _slice(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # the pattern's engine gave up on a long run of blanks
            return self._exact(text)

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id: entries byte-level decoded."""
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        byte = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            out[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        return out


class Grown:
    """A numpy array of whole numbers that grows at its end."""

    def __init__(self, shape: tuple[int, ...] = ()):
        self.data, self.n = np.empty((1 << 10, *shape), np.int64), 0

    def __len__(self) -> int:
        return self.n

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            grown = np.empty((max(2 * len(self.data), self.n + len(more)), *self.data.shape[1:]), np.int64)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)

    def values(self) -> np.ndarray:
        return self.data[:self.n]


class Numbers(dict):
    """Numbers its keys in the order in which they are asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Aligner:
    """Encodes and aligns texts with the two vocabularies; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = PlainEncoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                   for k, p in enumerate(pieces)]
        bytes_a = self.a.token_bytes()
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.width_a, self.width_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        self.n_b = len(pieces)
        self.whole = any(_CROSSING.search(p) for p in pieces if not p.startswith("<"))
        self._forget()
        # ids in words, with what follows them: another id of the side, the other side, the next group
        self.words = [f"{k}{end}" for end in ",|" for k in range(len(bytes_a))] + [
            f"{k}{end}" for end in ",;" for k in range(self.n_b)]

    def _forget(self) -> None:
        self.units = Numbers()
        self.slots = Grown()  # where a unit's results stand
        self.counts = Grown((4,))  # n_a, n_b, n_groups, n_links; n_groups is 0 where the bytes differ
        self.texts: list[str] = []
        self.ends, self.codes, self.times = Grown(), Grown(), Grown()

    def cut(self, text: str) -> list[str]:
        """The units of a text, each without the space in front of it."""
        if self.whole:
            return [text]
        if _ODD.search(text):
            return [u[1:] for u in _CUT.split(" " + text)]
        return text.split(" ")

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of texts in a row, with a space in front of each, and whether their bytes are those of the texts."""
        row = " " + " ".join(texts)
        parts = [" ".join(texts[k:k + 32]) for k in range(0, len(texts), 32)]
        a = self.a.encode(row).astype(np.int64)
        b = np.fromiter(chain.from_iterable(self.b.encode(parts, num_threads=1)), np.int64)
        raw = row.encode()
        same = (b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == raw)
        return a, b, same

    def _learn(self) -> None:
        """Encode and align units that got a number just now; those that can stand in a row are encoded as one text."""
        new = list(islice(self.units, len(self.slots), None))
        if not new:
            return
        alone = [k for k, u in enumerate(new) if self.whole or not u or u[0].isspace() or u[-1].isspace()]
        apart = set(alone)
        rows = [k for k in range(len(new)) if k not in apart] if alone else list(range(len(new)))
        slots = np.empty(len(new), np.int64)
        if rows:
            row = [new[k] for k in rows] if alone else new
            a, b, same = self._encode(row)
            if same:
                slots[rows] = len(self.counts) + np.arange(len(rows))
                self._add(row, a, b)
            else:
                alone = range(len(new))
        for k in alone:
            a, b, same = self._encode([new[k]])
            slots[k] = len(self.counts)
            if same:
                self._add([new[k]], a, b)
            else:
                self.counts.add(np.zeros((1, 4), np.int64))
                self.ends.add(np.array([len(self.codes)]))
                self.texts.append("")
        self.slots.add(slots)

    def _add(self, new: list[str], a: np.ndarray, b: np.ndarray) -> None:
        n, bounds = len(new), np.cumsum(np.fromiter((len(u.encode()) + 1 for u in new), np.int64, len(new)))
        unit_a = np.searchsorted(bounds, np.cumsum(self.width_a[a]))
        unit_b = np.searchsorted(bounds, np.cumsum(self.width_b[b]))
        group_a, group_b, heads = coalesce(self.width_a[a], self.width_b[b])
        unit_of = np.empty(heads, np.int64)
        unit_of[group_a] = unit_a
        in_a, in_b = np.bincount(group_a, minlength=heads), np.bincount(group_b, minlength=heads)
        held = np.concatenate([[0], np.cumsum(in_a * in_b)])
        groups = np.bincount(unit_of, minlength=n)
        upto = np.cumsum(groups)
        self.counts.add(np.stack([np.bincount(unit_a, minlength=n), np.bincount(unit_b, minlength=n), groups,
                                  held[upto] - held[upto - groups]], 1))
        unit, code, times = links(a, b, group_a, group_b, in_a, in_b, unit_of, self.n_b)
        order = np.argsort(unit, kind="stable")
        before = len(self.codes)
        self.codes.add(code[order])
        self.times.add(times[order])
        self.ends.add(before + np.cumsum(np.bincount(unit, minlength=n)))
        self.texts += self._spell(a, b, group_a, group_b, unit_a, unit_b, n)

    def _spell(self, a, b, group_a, group_b, unit_a, unit_b, n) -> list[str]:
        """The units' groups in words, each ending with a separator."""
        last_a, last_b = np.ones(len(a), bool), np.ones(len(b), bool)
        last_a[:-1] = group_a[1:] != group_a[:-1]
        last_b[:-1] = group_b[1:] != group_b[:-1]
        size = len(self.bytes_a)
        word = np.concatenate([a + size * last_a, 2 * size + b + self.n_b * last_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        parts = list(map(self.words.__getitem__, word[order].tolist()))
        ends = np.cumsum(np.bincount(unit_a, minlength=n) + np.bincount(unit_b, minlength=n)).tolist()
        return ["".join(parts[s:e]) for s, e in zip([0, *ends], ends)]

    def documents(self, texts: list[str | None]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups in words, distinct pair codes, their times) of every text."""
        at = 0
        while at < len(texts):
            part, held = [], 0
            while at < len(texts) and (not part or held < STEP):
                part.append(self.cut(texts[at]) if texts[at] else [])
                held += len(texts[at] or "")
                at += 1
            if len(self.units) > CACHE:
                self._forget()
            own = [np.fromiter(map(self.units.__getitem__, units), np.int64, len(units)) for units in part]
            self._learn()
            for units, numbers in zip(part, own):
                yield self._document(units, numbers)

    def _document(self, units: list[str], numbers: np.ndarray) -> tuple:
        nothing = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        if not units:
            return nothing
        own = self.slots.values()[numbers]
        counts = self.counts.values()[own]
        if not counts[:, 2].all():
            if len(units) == 1:
                return nothing
            whole = " ".join(units)  # judged as a whole
            number = self.units[whole]
            self._learn()
            return self._document([whole], np.array([number]))
        ends = self.ends.values()
        begins = np.where(own, ends[own - 1], 0)
        sizes = ends[own] - begins
        place = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        codes, times = added(self.codes.values()[place], self.times.values()[place])
        groups = "".join(map(self.texts.__getitem__, own.tolist()))[:-1]
        return (*map(int, counts.sum(0)), groups, codes, times)


def coalesce(width_a: np.ndarray, width_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every A and every B token, and the number of groups, from the tokens' lengths in bytes; both sides
    cover the same bytes."""
    width = np.concatenate([width_a, width_b])
    end = np.concatenate([np.cumsum(width_a), np.cumsum(width_b)])
    start = end - width
    side = np.repeat([0, 1], [len(width_a), len(width_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:len(width_a)], group[len(width_a):], int(breaks.sum())


def added(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sum of their times."""
    if not len(codes):
        return codes, times
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(times[order], first)


def links(a, b, group_a, group_b, in_a, in_b, unit_of, n_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, pair code, times) of all links; a code may come several times."""
    from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    plain = in_a * in_b <= PLAIN
    per = np.where(plain[group_a], in_b[group_a], 0)  # every A token meets its group's B tokens
    k = np.repeat(np.arange(len(a)), per)
    g = group_a[k]
    meets = b[from_b[g] + np.arange(len(k)) - np.repeat(np.cumsum(per) - per, per)]
    units, codes, times = [unit_of[g]], [a[k] * n_b + meets], [np.ones(len(k), np.int64)]
    for g in np.flatnonzero(~plain):
        one, n_one = np.unique(a[from_a[g]:from_a[g] + in_a[g]], return_counts=True)
        two, n_two = np.unique(b[from_b[g]:from_b[g] + in_b[g]], return_counts=True)
        codes.append((one[:, None] * n_b + two).ravel())
        times.append((n_one[:, None] * n_two).ravel())
        units.append(np.full(len(codes[-1]), unit_of[g]))
    return np.concatenate(units), np.concatenate(codes), np.concatenate(times)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two vocabulary files (kept between tasks)."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of tokens, groups and links, the groups' digest, the distinct linked pairs as codes (A id * size of
    B + B id) in order, and how often each is linked (see ``SCHEMA``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        out, held = [], 0

        def batch() -> pa.RecordBatch:
            types = [pa.int64()] * 5 + [pa.string()] + [pa.list_(pa.int64())] * 2
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             [f.split()[0] for f in SCHEMA.split(", ")])
            out.clear()
            return got

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for doc_id, (*counts, groups, codes, times) in zip(ids, al.documents(texts)):
                sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                out.append((doc_id, *counts, sha, codes, times))
                held += len(codes)
                if len(out) >= 1000 or held > FLUSH:
                    yield batch()
                    held = 0
        if out:
            yield batch()

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(code, n, best): in how many rows a pair is linked, and whether no pair of its A id is in more."""
    sums = stored(aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")),
                  "pair-counts")
    a = F.expr(f"code div {int(size_b)}").alias("a")
    most = sums.groupBy(a).agg(F.max("n").alias("most"))
    return sums.select("code", "n", a).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _heavy(counts: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The count from which a pair is looked up in tasks, and such pairs in order: at most ``HEAVY``, since each has its
    share of all cases."""
    least = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // HEAVY))
    rows = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(rows.column("code").to_numpy())
    return least, tuple(rows.column(c).to_numpy()[order] for c in ("code", "n", "best"))


def _ask(aligned: DataFrame, heavy: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Rows with the sums over their heavy pairs; ``codes`` and ``times`` keep the others."""
    known = aligned.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = known.value
        for b in batches:
            lists = b.column("codes")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            codes = lists.values.to_numpy()[bounds[0]:bounds[-1]]
            own = b.column("times")
            times = own.values.to_numpy()[own.offsets[0].as_py():own.offsets[-1].as_py()]
            bounds = bounds - bounds[0]
            at = np.minimum(np.searchsorted(code, codes), max(0, len(code) - 1))
            hit = code[at] == codes if len(code) else np.zeros(len(codes), bool)
            at = np.where(hit, at, 0)

            def per_row(x: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])

            ones = hit.astype(np.int64) * times if len(code) else np.zeros(len(codes), np.int64)
            rest = pa.array(np.concatenate([[0], np.cumsum(~hit)])[bounds].astype(np.int32))
            cols = [b.column(c) for c in SIDE] + [b.column("row")]
            cols += [pa.array(per_row(ones * best[at] if len(code) else ones)), pa.array(per_row(ones * n[at] if len(code) else ones))]
            cols += [pa.ListArray.from_arrays(rest, pa.array(x[~hit])) for x in (codes, times)]
            yield pa.RecordBatch.from_arrays(cols, [*SIDE, "row", "n_best", "count_sum", "codes", "times"])

    schema = SCHEMA.replace(", codes", ", row long, n_best long, count_sum long, codes")
    return aligned.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema)


def report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens of both sides, groups, links, links that are best of their A id, sum of the links' counts, and
    the groups' digest."""
    import sentencepiece

    aligned = stored(align(docs, path_a, path_b, id_col, text), "aligned")
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = stored(pair_counts(aligned, size_b), "pair-best")
    least, heavy = _heavy(counts)
    asked = stored(_ask(aligned, heavy), "pairs-asked")
    each = asked.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select(
        "row", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    sums = each.join(counts.where(F.col("n") < least), "code").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    whole = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).cast("long").alias(c)
    return asked.drop("codes", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", whole("n_best", "more_best"), whole("count_sum", "more_sum"),
        "groups_sha256")
