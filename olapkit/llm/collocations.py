"""Phrase collocations counted in counting quotient filters.

1. Texts are split into pieces and words once. Tasks write chunks: word numbers of the chunk in order (0 between pieces),
   and the chunk's vocabulary with counts.
2. Words are counted per language over all chunks. Those with ``LEAST`` or more occurrences get ids; a phrase that often
   has no other words. Every chunk gets the ids of its own words by a join, so no vocabulary is broadcast.
3. For phrases of 2, 3 and 4 words in turn: every chunk packs the ids of its phrases into keys and counts them in counting
   quotient filters (``quotient.py``), one for each of 256 leading quotients. Filters of up to 256 shards with the same
   leading quotient are merged at a time, and split by the next 8 bits, until every shard is in one filter. A merge so
   holds about as much as one chunk, whatever the size of the corpus. Phrases with ``LEAST`` or more occurrences stay.
4. A phrase is only counted if its two parts that are a word shorter may be that frequent: a bit array of fixed size holds
   a hash of each of these. It errs on the safe side only, so counts are exact (in a corpus that fills it, it saves
   nothing).
5. Candidates are joined with the counts of both sides of each cut and with the longer candidates around them; the best
   of a language are ranked in salted groups first.

Defined results: null texts are empty, a null language is ``und``; texts without words add nothing. Repeated rows count
as often as they stand there; ids are not read. Ties of the score and count are in the order of the phrase's UTF-8 bytes.
An empty table gives no rows. A text of any length is read in slices; a chunk that ends inside a piece gives its last
three words to the next one, which counts the phrases that end behind them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quotient
from .common import stored
from .hashing import mix

LEAST, LONGEST, TOP = 30, 4, 2000
#: Words of a chunk; bytes of a text that are split at a time; words in a row of a chunk's vocabulary.
CHUNK, SLICE, ROW = 1 << 19, 1 << 20, 1 << 14
#: Shards that are merged at a time (as many as there are values of the leading 8 bits).
FAN = 256
#: Bits of the array of frequent phrases, and candidates ranked in one group.
FILTER_BITS, RANKED = 26, 1 << 17
#: Buckets in which word ids are given out.
ID_BUCKETS = 4096

_BREAK = b"\xff"  # in no UTF-8 text
_CLEAN = bytearray(range(256)).lower()
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _CLEAN[_c] = 0xFF
_CLEAN[9] = 0x20
_CLEAN = bytes(_CLEAN)
_SPACE = re.compile(rb"[ \xff]")
CHUNKS = "chunk long, skip int, seq binary, lang string, words array<string>, numbers array<int>, counts array<long>"


def _cleaned(text: str, step: int) -> Iterator[bytes]:
    """Slices of a text, lower-cased, with one sign for all breaks between pieces; slices end in front of a blank."""
    data, at = text.encode("utf-8", "surrogatepass").translate(_CLEAN), 0
    while len(data) - at > step:
        m = _SPACE.search(data, at + step)
        if not m:
            break
        yield data[at:m.start()]
        at = m.start()
    yield data[at:]


class _Numbers(dict):
    """Numbers the words of a language in a chunk; all languages of the chunk share ``given``, the numbers' words."""

    def __init__(self, given: list):
        super().__init__({_BREAK: 0})
        self.given = given

    def __missing__(self, word: bytes) -> int:
        self.given.append(word)
        self[word] = n = len(self.given)
        return n


class _Chunk:
    def __init__(self, name: int):
        self.name, self.given, self.langs, self.seq, self.skip, self.size = name, [], {}, [], 0, 0

    def add(self, lang: str, words: list[bytes]) -> None:
        if lang not in self.langs:
            self.langs[lang] = _Numbers(self.given)
        self.seq.append(np.fromiter(map(self.langs[lang].__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self) -> list[tuple]:
        seq = np.concatenate([np.zeros(0, np.int32), *self.seq])
        counts = np.bincount(seq[self.skip:], minlength=len(self.given) + 1)
        out = [(self.name, self.skip, seq.tobytes(), None, None, None, None)]
        for lang, numbers in self.langs.items():
            own = np.fromiter(numbers.values(), np.int32, len(numbers))[1:]
            for k in range(0, len(own), ROW):
                part = own[k:k + ROW]
                out.append((self.name, None, None, lang, [self.given[n - 1].decode() for n in part.tolist()], part,
                            counts[part]))
        return out


def _chunks(docs: DataFrame, lang: str, text: str, limit: int, step: int) -> DataFrame:
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()),
             pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = _Chunk(TaskContext.get().partitionId() << 32)

        def batch(c: _Chunk) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*c.rows()), kinds)], names)

        for b in batches:
            for of, body in zip(b.column(0).to_pylist(), b.column(1)):
                tail: list[bytes] = []  # last words of the open piece
                for part in _cleaned(body.as_py() or "", step):
                    if chunk.size >= limit:
                        yield batch(chunk)
                        chunk = _Chunk(chunk.name + 1)
                        if tail:
                            chunk.add(of, tail)
                            chunk.skip = len(tail)
                    words = part.replace(_BREAK, b" \xff ").split()
                    chunk.add(of, words)
                    tail = (tail + words[-LONGEST:])[1 - LONGEST:]
                    for k, w in enumerate(tail[::-1]):
                        if w == _BREAK:
                            tail = tail[len(tail) - k:]
                            break
                chunk.add(of, [_BREAK])
        if chunk.size:
            yield batch(chunk)

    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, CHUNKS)


def _word_ids(vocabulary: DataFrame, least: int) -> DataFrame:
    """(lang, word, n, id) of frequent words. Ids are dense: places in buckets of even size."""
    frequent = vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(ID_BUCKETS))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return frequent.withColumn("bucket", bucket).select(
        "lang", "word", "n", ((place - 1) * ID_BUCKETS + F.col("bucket") + 1).cast("long").alias("id"))


def _coded(chunks: DataFrame, vocabulary: DataFrame, ids: DataFrame) -> DataFrame:
    """(chunk, skip, ids): the chunks' sequences in word ids; 0 for breaks and for words without an id."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number, own = right.column("number").to_numpy(), right.column("id").to_numpy()
        out = []
        for seq in left.column("seq"):
            local = np.frombuffer(seq.as_buffer(), np.int32)
            table = np.zeros(max(int(local.max(initial=0)), int(number.max(initial=0))) + 1, np.uint32)
            table[number] = own
            out.append(table[local].tobytes())
        return pa.table({"chunk": left.column("chunk"), "skip": left.column("skip"),
                         "ids": pa.array(out, pa.binary())})

    known = vocabulary.join(ids.select("lang", "word", "id"), ["lang", "word"]).select(
        F.col("chunk").alias("of"), "number", "id")
    return (chunks.where("seq is not null").select("chunk", "skip", "seq").groupBy("chunk")
            .cogroup(known.groupBy("of")).applyInArrow(run, "chunk long, skip int, ids binary"))


def _halves(n: int, bits: int) -> tuple[int, int]:
    """Bits of the two halves of a phrase's key: whole words in each."""
    return -(-n // 2) * bits, n // 2 * bits


def _joined(words: list[np.ndarray], bits: int) -> np.ndarray:
    out = words[0]
    for w in words[1:]:
        out = out << np.uint64(bits) | w
    return out


def _position(words: list[np.ndarray], filter_bits: int) -> np.ndarray:
    """Place of a phrase in the bit array of frequent phrases."""
    x = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        x = mix(x * np.uint64(0x9E3779B97F4A7C15 | 1) + w)
    return (x >> np.uint64(64 - filter_bits)).astype(np.int64)


def _phrases(ids: np.ndarray, skip: int, n: int, frequent: np.ndarray | None) -> list[np.ndarray]:
    """The words of all phrases of ``n`` words that end at ``skip`` or later and can be frequent: an array for each word."""
    ids, m = ids.astype(np.uint64), len(ids) - n + 1
    if m <= 0:
        return [np.empty(0, np.uint64)] * n
    good = np.ones(m, bool)
    good[:max(0, skip - n + 1)] = False
    for k in range(n):
        good &= ids[k:k + m] != 0
    at = np.flatnonzero(good)
    if frequent is not None:
        for k in (0, 1):  # both shorter parts
            p = _position([ids[at + k + j] for j in range(n - 1)], (8 * len(frequent)).bit_length() - 1)
            at = at[(frequent[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)]
    return [ids[at + j] for j in range(n)]


FILTERS = "path long, shard long, filter binary"


def _filters(coded: DataFrame, n: int, bits: int, frequent: np.ndarray | None, groups: int) -> DataFrame:
    """(path, shard, filter): counters of the phrases of every chunk."""
    wide, low = _halves(n, bits)
    shared = coded.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, skip, seq in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = _phrases(np.frombuffer(seq.as_buffer(), np.uint32), skip, n, shared.value)
                key = quotient.permute(_joined(words[:-(-n // 2)], bits), _joined(words[-(-n // 2):], bits), wide, low)
                rows = list(quotient.pieces(*quotient.counted(*key, None, wide, low), wide, low))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _ in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()),
                         pa.array([f for _, f in rows], pa.binary())], ["path", "shard", "filter"])

    return coded.select("chunk", "skip", "ids").mapInArrow(run, FILTERS).withColumn("shard", _group("shard", groups))


def _group(shard: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(shard), F.lit(groups))


def _merged(filters: DataFrame, n: int, bits: int, done: int, least: int | None = None,
            filter_bits: int = FILTER_BITS) -> DataFrame:
    """Filters of the same path and shard group as one: split by the next 8 bits, or (``least`` given, all shards in one
    group) the frequent phrases with their counts. ``done`` bits stand in the path."""
    wide, low = _halves(n, bits)

    def merge(key: tuple, t: pa.Table) -> tuple:
        path = key[0].as_py()
        parts = [quotient.unpack(f.as_py(), path, wide - done, low) for f in t.column("filter")]
        return path, quotient.counted(*(np.concatenate(x) for x in zip(*parts)), wide, low)

    def split(key: tuple, t: pa.Table) -> pa.Table:
        path, (left, right, count) = merge(key, t)
        rows = list(quotient.pieces(left, right, count, wide - done, low, path))
        return pa.table({"path": pa.array([p for p, _ in rows], pa.int64()),
                         "shard": pa.array([key[1].as_py()] * len(rows), pa.int64()),
                         "filter": pa.array([f for _, f in rows], pa.binary())})

    def final(key: tuple, t: pa.Table) -> pa.Table:
        _, (left, right, count) = merge(key, t)
        keep = count >= least
        left, right = quotient.restore(left[keep], right[keep], wide, low)
        mask, words = np.uint64((1 << bits) - 1), []
        for half, size in ((left, -(-n // 2)), (right, n // 2)):
            words += [half >> np.uint64(bits * (size - 1 - k)) & mask for k in range(size)]
        flat = np.stack(words, 1).astype(np.int64).ravel()
        g = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n, dtype=np.int32)), pa.array(flat))
        return pa.table({"g": g, "n": pa.array(count[keep]), "position": pa.array(_position(words, filter_bits))})

    grouped = filters.groupBy("path", "shard")
    if least is None:
        return grouped.applyInArrow(split, FILTERS)
    return grouped.applyInArrow(final, "g array<long>, n long, position long")


def _bit_array(counts: DataFrame, filter_bits: int) -> np.ndarray:
    """Bits of fixed number, set at the frequent phrases' positions; at most 2^(filter_bits - 6) rows are fetched."""
    bit = F.expr("shiftleft(1L, cast(position & 63 as int))")
    rows = counts.groupBy(F.expr("position >> 6").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << max(0, filter_bits - 6), "<i8")
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def phrase_counts(coded: DataFrame, largest_id: int, least: int = LEAST, longest: int = LONGEST,
                  filter_bits: int = FILTER_BITS) -> list[DataFrame]:
    """(g: word ids, n) of all phrases of 2 to ``longest`` words with at least ``least`` occurrences, by length."""
    shards, levels = coded.count(), 1
    while FAN ** levels < shards:
        levels += 1
    bits = max(8 * levels, largest_id.bit_length())
    out, frequent = [], None
    for n in range(2, longest + 1):
        groups = -(-shards // FAN) or 1
        filters, done = _filters(coded, n, bits, frequent, groups), 8
        while groups > 1:
            filters = stored(_merged(filters, n, bits, done), f"filters-{n}")
            groups, done = -(-groups // FAN), done + 8
            filters = filters.withColumn("shard", _group("shard", groups))
        out.append(stored(_merged(filters, n, bits, done, least, filter_bits), f"phrases-{n}"))
        if n < longest:
            frequent = _bit_array(out[-1], filter_bits)
    return out


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 80, lang: str = "lang",
                 text: str = "text", chunk: int = CHUNK, step: int = SLICE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score. A phrase is dropped if a longer one
    around it has ``share`` percent of its occurrences. ``chunk``, ``step`` and ``filter_bits`` change no result."""
    chunks = stored(_chunks(docs, lang, text, chunk, step), "word-chunks")
    vocabulary = chunks.where("words is not null").select(
        "chunk", "lang", F.explode(F.arrays_zip("words", "numbers", "counts")).alias("w")).select(
        "chunk", "lang", F.col("w.words").alias("word"), F.col("w.numbers").alias("number"), F.col("w.counts").alias("n"))
    sizes = chunks.where("words is not null").groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    ids = stored(_word_ids(vocabulary, least), "word-ids")
    coded = stored(_coded(chunks, vocabulary, ids), "coded-chunks")
    counted = phrase_counts(coded, ids.agg(F.max("id")).first()[0] or 1, least, filter_bits=filter_bits)
    found = counted[0].select("g", "n")
    for c in counted[1:]:
        found = found.unionByName(c.select("g", "n"))
    known = ids.select(F.array("id").alias("g"), "n").unionByName(found)

    # every cut with the counts of its sides; the lowest score counts
    cuts = found.select("g", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("g") - 1)).alias("k"))
    side = lambda c, part: known.select(F.col("g").alias(part), F.col("n").alias(c))
    cuts = (cuts.withColumn("first", F.expr("slice(g, 1, k)")).withColumn("rest", F.expr("slice(g, k + 1, size(g) - k)"))
            .join(side("l", "first"), "first").join(side("r", "rest"), "rest"))
    score = F.expr("(cast(2000000 as decimal(38, 0)) * a) div (l + r)").cast("long")
    best = cuts.groupBy("g", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # parts of longer phrases
    inner = found.where(F.size("g") > 2).select("n", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("g") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.size("g") - m + 1), lambda s: F.slice("g", s, m))))).alias("g"))
    around = inner.groupBy("g").agg(F.max("n").alias("around"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    kept = best.join(around, "g", "left").where(
        F.col("around").isNull() | (100 * wide("around") < share * wide("a")))

    # words again
    each = kept.select("g", "a", "cut", F.posexplode("g").alias("at", "id")).join(ids.select("id", "lang", "word"), "id")
    named = stored(each.groupBy("g", "a", "cut").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("ws")).select(
        "lang", F.array_join(F.transform("ws", lambda w: w["word"]), " ").alias("phrase"), "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")), "collocations")

    # ranks: the best of each salted group first, so no task sees a whole language
    salts = max(1, named.count() // RANKED)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    few = (named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", rank("lang", "salt"))
           .where(F.col("rank") <= top).withColumn("rank", rank("lang")).where(F.col("rank") <= top))
    return few.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations(docs)


def op11_sql(least: int = LEAST, top: int = TOP) -> str:
    """DuckDB SQL for ``report`` over the table ``documents``."""
    upper = "".join(map(chr, range(65, 91)))
    lead = ", ".join(f"lead(w, {k}) OVER p AS w{k + 1}" for k in range(1, LONGEST))
    phrase = {(i, j): " || ' ' || ".join(f"w{k}" for k in range(i, j + 1))
              for i in range(1, LONGEST + 1) for j in range(i, LONGEST + 1)}
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, {', '.join(f'w{k}' if k <= m else f'NULL AS w{k}' for k in range(1, LONGEST + 1))}, "
        f"{phrase[1, m]} AS phrase FROM s WHERE w{m} IS NOT NULL" for m in range(1, LONGEST + 1))
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, {phrase[1, k]} AS lp, {phrase[k + 1, m]} AS rp FROM f WHERE m = {m}"
        for m in range(2, LONGEST + 1) for k in range(1, m))
    inner = " UNION ALL ".join(
        f"SELECT lang, {phrase[i, j]} AS phrase, a FROM f WHERE m = {m}"
        for m in range(3, LONGEST + 1) for i in range(1, m) for j in range(i + 1, m + 1) if j - i + 1 < m)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents),
p AS (SELECT rid, lang, unnest(range(len(ps))) AS pid, unnest(ps) AS p
      FROM (SELECT rid, lang, regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]') AS ps FROM d)),
q AS (SELECT rid, lang, pid, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
o AS (SELECT rid, lang, pid, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM q),
s AS (SELECT lang, w AS w1, {lead} FROM o WINDOW p AS (PARTITION BY rid, pid ORDER BY i)),
z AS (SELECT lang, count(*) AS n FROM o GROUP BY lang),
g AS ({grams}),
f AS (SELECT lang, m, phrase, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, any_value(w4) AS w4,
             count(*) AS a FROM g GROUP BY lang, m, phrase HAVING count(*) >= {least}),
c AS ({cuts}),
e AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, 2000000::HUGEINT * c.a // (x.a + y.a) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, phrase, max(a) AS around FROM ({inner}) GROUP BY lang, phrase),
v AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE around IS NULL OR 100 * around < 80 * a)
SELECT v.lang, row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       z.n, score::BIGINT AS score
FROM v JOIN z ON z.lang = v.lang QUALIFY rank <= {top}"""
