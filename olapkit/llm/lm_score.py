"""Cross-entropy difference between a target and a background n-gram model.

Both models are bigram models over one vocabulary, with the same kept bigrams, discount and back-off, so that they
differ in their counts alone. The score of a document is its loss per token under the target model minus that under the
background model: the lower, the more it resembles the target.

The vocabulary holds every word of both corpora, and every bigram is kept, whatever the size of the corpora. Only a
caller who names ``word_share`` (or ``bigram_share``) leaves out words under that share of both corpora, which become
one unknown word (or bigrams under that share of each corpus). With D the discount, c counts of one model and K the
kept bigrams, ``P(b | a) = max(c(ab) - D, 0) / c(a) [ab in K] + rest(a) * U(b)``, where ``rest(a)`` is what the kept
bigrams leave and ``U(b) = (c(b) + 1/2) / (N + (V + 1) / 2)``; each P(. | a) sums to 1. A text's first word follows a
start mark. A document's word that is in neither corpus has no counts.

The model grows with the corpora, so it is never in one place:

1. Texts become chunks of about ``HELD`` words: the distinct words, and the texts as numbers of them.
2. Each chunk sends its distinct bigrams to buckets, by their first word; those of first words so frequent that a
   bucket would grow with them (at most ``4 * buckets`` words) are dealt by both words. A bucket adds up the counts,
   answers each chunk of documents with the counts of its bigrams, and sums c(a) and the kept mass by first word.
3. Likewise the words of a chunk are answered with c(b), c(a) and the kept mass.
4. A chunk with its answers has all that its losses need.

The number of buckets grows with the number of words; a bucket and a chunk are what a task holds at a time.

Defined results: a null or empty text, or one without words, has 0 tokens and losses and score 0. With an empty target
or background, that model is uniform. Null ids and repeated rows are scored like others; words are compared with A-Z in
lower case. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hashing import mix, text_words

DISCOUNT, HELD = 0.75, 1 << 20
#: Words and bigrams left out unless the caller says otherwise: none.
WORD_SHARE, BIGRAM_SHARE = 0.0, 0.0
#: Hashes of the start mark and of the unknown word.
START, OTHER = 0, 1
#: What a chunk is: counted for a model, or documents to be scored (which can be the background too).
TARGET, BACKGROUND, SCORED, BOTH, SUMS = range(5)
#: Rows between tasks: what is sent to a bucket, and what it answers (``n`` entries, compressed arrays).
SENT, SENT_ROW = ["bucket", "chunk", "kind", "n", "x", "y"], "bucket int, chunk long, kind int, n long, x binary, y binary"


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True) if x.size else b""


def _unpack(data: bytes, dtype, *shape: int) -> np.ndarray:
    size = int(np.prod(shape)) * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", dtype).reshape(shape)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], SENT)


def _counted(texts: DataFrame) -> DataFrame:
    """(key, n): the words of every text, counted in the task by ``HELD`` words at a time."""
    most = HELD

    def run(batches):
        held, size = [], 0

        def flush():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

        for b in batches:
            for _, words in text_words(b.column(0)):
                held.append(words)
                size += len(words)
                if size >= most:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "key long, n long")


def _vocabulary(corpora: list[DataFrame], share: float) -> np.ndarray:
    """The at most ``1 / share`` words with a share of both corpora, sorted."""
    one, two = (_counted(c) for c in corpora)
    words = stored(one.unionByName(two).groupBy("key").agg(F.sum("n").alias("n")), "lm-vocabulary")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    kept = words.where(F.col("n") >= max(1, share * total)).select("key").toArrow()
    return np.sort(kept.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _chunks(texts: DataFrame, kind: int, vocabulary) -> DataFrame:
    """Rows of (doc_id, text) as chunks: ids, words of each text, the start mark and the sorted distinct words with
    their counts, and the texts as places in these."""
    most = HELD

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        held, ids, lengths, size = [], [], [], 0

        def flush():
            words, tokens, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_inverse=True,
                                              return_counts=True)
            words = np.concatenate([np.array([START], np.uint64), words])
            own, n = pa.concat_arrays(ids), np.concatenate(lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 24 | made << 3 | kind]), pa.array([kind], pa.int32()), pa.array([len(tokens)]),
                 pa.array([len(words)]), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                 *(pa.array([x], pa.binary()) for x in (
                     n.nbytes.to_bytes(8, "little") + _pack(n), _pack(words), _pack(np.concatenate([[0], counts])),
                     _pack(tokens.astype(np.int32) + 1)))],
                ["chunk", "kind", "n", "v", "ids", "lengths", "words", "counts", "tokens"])

        for b in batches:
            n, at = np.zeros(len(b), np.int64), 0
            for row, words in text_words(b.column(1)):
                if vocabulary is not None:
                    known = vocabulary.value
                    place = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
                    words = np.where(known[place] == words, words, np.uint64(OTHER)) if len(known) else \
                        np.full(len(words), OTHER, np.uint64)
                n[row] = len(words)
                held.append(words)
                size += len(words)
                if size >= most:
                    ids.append(b.column(0).slice(at, row + 1 - at))
                    lengths.append(n[at:row + 1])
                    yield flush()
                    held, ids, lengths, size, at, made = [], [], [], 0, row + 1, made + 1
            ids.append(b.column(0).slice(at))
            lengths.append(n[at:])
            size += len(b) - at
        if any(map(len, lengths)):
            yield flush()

    return texts.mapInArrow(run, "chunk long, kind int, n long, v long, ids array<long>, lengths binary, words binary, "
                                 "counts binary, tokens binary")


def _frequent(chunks: DataFrame, share: float, total: int) -> np.ndarray:
    """At most ``2 / share`` words, with all among them that have ``share`` of the ``total`` words: of such a word, half
    at least is in chunks of which it has half that share."""

    def run(batches):
        for b in batches:
            for n, v, words, counts in zip(*(b.column(k) for k in range(4))):
                w, c = _unpack(words.as_py(), np.uint64, v.as_py()), _unpack(counts.as_py(), np.int64, v.as_py())
                often = (2 * c >= share * n.as_py()) & (c > 0)
                yield pa.RecordBatch.from_arrays([pa.array(w[often].view(np.int64)), pa.array(c[often])], ["word", "n"])

    found = chunks.select("n", "v", "words", "counts").mapInArrow(run, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") * 2 >= share * total).select("word").toArrow()
    words = found.column(0).to_numpy().astype(np.int64).view(np.uint64)
    return np.sort(np.concatenate([np.array([START], np.uint64), words]))


def _bigrams(v: int, tokens: np.ndarray, lengths: np.ndarray, **more):
    """np.unique of a chunk's bigrams, each as first place * v + second place."""
    before = np.concatenate([[0], tokens[:-1]]).astype(np.int64)
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return np.unique(before * v + tokens, **more)


def _split(bucket: np.ndarray, buckets: int):
    """Each bucket that has entries, with their places."""
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    return zip(used.tolist(), np.split(order, first[1:])) if len(used) else ()


def _dealt(words: np.ndarray, a: np.ndarray, b: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each bigram."""
    both = np.isin(words, frequent)[a]
    return (np.where(both, mix(words[a] + mix(words[b])), words[a]) % np.uint64(buckets)).astype(np.int64)


def _sent_bigrams(chunks: DataFrame, frequent, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, kind, n, v, lengths, words, tokens in zip(*(batch.column(k) for k in range(7))):
                chunk, kind, n, v = (x.as_py() for x in (chunk, kind, n, v))
                w, t = _unpack(words.as_py(), np.uint64, v), _unpack(tokens.as_py(), np.int32, n)
                key, count = _bigrams(v, t, _lengths(lengths.as_py()), return_counts=True)
                a, b = key // v, key % v
                rows = [(k, chunk, kind, len(at), _pack(np.stack([w[a[at]], w[b[at]]])), _pack(count[at]))
                        for k, at in _split(_dealt(w, a, b, frequent.value, buckets), buckets)]
                if rows:
                    yield _rows(rows)

    return chunks.select("chunk", "kind", "n", "v", "lengths", "words", "tokens").mapInArrow(run, SENT_ROW)


def _lengths(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.int64)


def _sent_words(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, kind, v, words, counts in zip(*(batch.column(k) for k in range(5))):
                w = _unpack(words.as_py(), np.uint64, v.as_py())
                c = _unpack(counts.as_py(), np.int64, v.as_py())
                yield _rows([(k, chunk.as_py(), kind.as_py(), len(at), _pack(w[at]), _pack(c[at]))
                             for k, at in _split((w % np.uint64(buckets)).astype(np.int64), buckets)])

    return chunks.select("chunk", "kind", "v", "words", "counts").mapInArrow(run, SENT_ROW)


def _gathered(batches) -> list[tuple]:
    return [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]


def _sums(group: np.ndarray, groups: int, values: np.ndarray) -> np.ndarray:
    return np.bincount(group, values, groups)


def _models(rows: list[tuple], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each entry counts for the target, and for the background."""
    kind = np.repeat([r[2] for r in rows], sizes)
    return kind == TARGET, (kind == BACKGROUND) | (kind == BOTH)


def _answered_bigrams(sent: DataFrame, buckets: int, least: tuple[float, float]) -> DataFrame:
    """Answers to chunks (the counts of their kept bigrams in both corpora), and sums by first word."""

    def run(batches):
        rows = _gathered(batches)
        if not rows:
            return
        sizes = [r[3] for r in rows]
        a, b = np.concatenate([_unpack(r[4], np.uint64, 2, r[3]) for r in rows], axis=1)
        n = np.concatenate([_unpack(r[5], np.int64, r[3]) for r in rows])
        order = np.lexsort((b, a))
        sa, sb = a[order], b[order]
        new = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
        group, first = np.empty(len(a), np.int64), sa[new]
        group[order] = np.cumsum(new) - 1
        counts = np.stack([_sums(group, len(first), n * m) for m in _models(rows, sizes)])
        kept = (counts[0] >= least[0]) | (counts[1] >= least[1])
        used = np.maximum(counts - DISCOUNT, 0) * kept
        start = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        sums, word = np.add.reduceat(np.concatenate([counts, used]), start, axis=1), first[start]
        yield _rows([(k, -1, SUMS, len(at), _pack(word[at]), _pack(sums[:, at]))
                     for k, at in _split((word % np.uint64(buckets)).astype(np.int64), buckets)])
        counts, ends = (counts * kept).astype(np.int64), np.cumsum(sizes)
        for r, end in zip(rows, ends):
            if r[2] in (SCORED, BOTH):
                yield _rows([(r[0], r[1], r[2], r[3], _pack(counts[:, group[end - r[3]:end]]), None)])

    return sent.repartitionById(buckets, "bucket").mapInArrow(run, SENT_ROW)


def _answered_words(sent: DataFrame, buckets: int) -> DataFrame:
    """Answers to chunks: c(b), c(a) and the kept mass by model, six numbers a word; and the number of words."""

    def run(batches):
        rows = _gathered(batches)
        if not rows:
            return
        sizes = [r[3] for r in rows]
        word, group = np.unique(np.concatenate([_unpack(r[4], np.uint64, r[3]) for r in rows]), return_inverse=True)
        n = np.concatenate([np.zeros(r[3], np.int64) if r[2] == SUMS else _unpack(r[5], np.int64, r[3]) for r in rows])
        by = np.concatenate([_unpack(r[5], float, 4, r[3]) if r[2] == SUMS else np.zeros((4, r[3])) for r in rows], axis=1)
        values = np.stack([*(_sums(group, len(word), n * m) for m in _models(rows, sizes)),
                           *(_sums(group, len(word), x) for x in by)])
        yield _rows([(rows[0][0], -1, SUMS, int(np.sum(values[0] + values[1] > 0)), None, None)])
        for r, end in zip(rows, np.cumsum(sizes)):
            if r[2] in (SCORED, BOTH):
                yield _rows([(r[0], r[1], r[2], r[3], None, _pack(values[:, group[end - r[3]:end]]))])

    return sent.repartitionById(buckets, "bucket").mapInArrow(run, SENT_ROW)


def losses(counts: np.ndarray, a: np.ndarray, b: np.ndarray, values: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Losses of bigrams by model (2, bigrams): their ``counts``, the places of their words in ``values`` (six a word),
    the number of words of the corpora ``n`` and of the vocabulary ``size``."""
    uni = (values[0:2] + 0.5) / (n[:, None] + 0.5 * (size + 1))
    before, used = values[2:4], values[4:6]
    rest = np.divide(before - used, before, out=np.ones(before.shape), where=before > 0)
    mass = np.divide(np.maximum(counts - DISCOUNT, 0), before[:, a], out=np.zeros(counts.shape), where=before[:, a] > 0)
    return -np.log(mass + rest[:, a] * uni[:, b])


def score(docs: DataFrame, target: DataFrame, background: DataFrame | None = None, id_col: str = "doc_id",
          text: str = "text", word_share: float = WORD_SHARE, bigram_share: float = BIGRAM_SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, score. ``target`` and ``background`` have one
    column; without ``background`` the documents are it."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    other = own.select("text") if background is None else background
    vocabulary = spark.sparkContext.broadcast(_vocabulary([target, other], word_share)) if word_share > 0 else None
    parts = [(own, SCORED if background is not None else BOTH), (target, TARGET)]
    parts += [(background, BACKGROUND)] if background is not None else []
    made = None
    for df, kind in parts:
        df = df if kind in (SCORED, BOTH) else df.select(F.lit(None).cast("long").alias("doc_id"), F.col(df.columns[0]))
        one = _chunks(df, kind, vocabulary)
        made = one if made is None else made.unionByName(one)
    chunks = stored(made, "lm-chunks")
    words = {r[0]: r[1] for r in chunks.groupBy("kind").agg(F.sum("n")).collect()}
    n = np.array([words.get(TARGET, 0), words.get(BACKGROUND, 0) + words.get(BOTH, 0)], float)
    total = sum(words.values())
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // HELD))
    frequent = spark.sparkContext.broadcast(_frequent(chunks, 1 / (2 * buckets), total))
    least = tuple(max(1.0, bigram_share * x) for x in n)
    answered = stored(_answered_bigrams(_sent_bigrams(chunks, frequent, buckets), buckets, least), "lm-bigrams")
    sums = answered.where(F.col("kind") == SUMS)
    about = stored(_answered_words(_sent_words(chunks, buckets).unionByName(sums), buckets), "lm-words")
    size = len(vocabulary.value) if vocabulary is not None else about.where(F.col("kind") == SUMS).agg(
        F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    answers = answered.unionByName(about).where(F.col("kind") != SUMS).select("chunk", "bucket", "n", "x", "y")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()),
                        ("background_loss", pa.float64()), ("score", pa.float64())])

    def finish(body: pa.Table, got: pa.Table) -> pa.Table:
        out = []
        for chunk in body.to_batches():
            for m, v, ids, lengths, w, t in zip(*(chunk.column(k) for k in range(1, 7))):
                m, v, length = m.as_py(), v.as_py(), _lengths(lengths.as_py())
                w, t = _unpack(w.as_py(), np.uint64, v), _unpack(t.as_py(), np.int32, m)
                key, place = _bigrams(v, t, length, return_inverse=True)
                a, b = key // v, key % v
                counts, values = np.full((2, len(key)), np.nan), np.full((6, v), np.nan)
                pairs = dict(_split(_dealt(w, a, b, frequent.value, buckets), buckets))
                singles = dict(_split((w % np.uint64(buckets)).astype(np.int64), buckets))
                for _, k, size_, x, y in zip(*(c.to_pylist() for c in got.columns)):
                    if x is not None:
                        counts[:, pairs[k]] = _unpack(x, np.int64, 2, size_)
                    else:
                        values[:, singles[k]] = _unpack(y, float, 6, size_)
                if np.isnan(counts).any() or np.isnan(values).any():
                    raise ValueError("a chunk lacks answers")
                loss, full = np.zeros((2, len(length))), length > 0
                if m:
                    each = losses(counts, a, b, values, n, size)[:, place]
                    loss[:, full] = np.add.reduceat(each, (np.cumsum(length) - length)[full], axis=1) / length[full]
                out.append(pa.Table.from_arrays([ids.values, pa.array(length), pa.array(loss[0]), pa.array(loss[1]),
                                                 pa.array(loss[0] - loss[1])], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    bodies = chunks.where(F.col("kind").isin(SCORED, BOTH)).select("chunk", "n", "v", "ids", "lengths", "words", "tokens")
    return bodies.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def report(docs: DataFrame, conversations: DataFrame) -> DataFrame:
    """All documents, with conversations as target and the documents themselves as background."""
    return score(docs, conversations.select("text"))
