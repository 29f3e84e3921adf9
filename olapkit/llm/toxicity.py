"""Toxicity by class-conditional Kneser-Ney models of characters in words.

Two models, of toxic and of ordinary texts, give the probability of a character after the four before it (word borders
included). At that order each class has its own counts; what a class has not seen backs off to one shared Kneser-Ney
model of both classes' continuation counts, so a rare expression is worth the same to both and does not tip the
comparison. ``LL(toxic) - LL(ordinary)`` is summed per word and normalised by length: over the whole text, and over its
windows of one, two and four words, of which the most toxic counts, since a few words make a text toxic. A logistic
regression on these differences, fitted on labelled rows the models have not seen, turns them into a score.

Fitting uses every labelled row that is not held out, its text whole. N-grams are counted in tasks and summed by Spark;
the regression's Newton steps are sums over all rows of fold 0, measured by a model of the other folds; scores use the
model of all folds. What the driver and the tasks hold is the model: its size is the number of different n-grams, not of
rows. Labels and ids choose and mark training rows; scores are made from texts alone.

Defined results: null and empty texts and texts without letters get the score of no evidence (the fitted intercept
with a difference of 0 everywhere). A label that is null is no label; of several labels of an id the largest counts.
Without labels of both classes every score is 0. Repeated rows score alike; a null id is not held out. Only the id and
text columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder

ORDER, SAMPLE, SAMPLE_CHARS, FOLDS, CACHE = 5, 3000, 20_000, 3, 300_000
WINDOWS = (1, 2, 4)
THRESHOLD = 0.3
DISCOUNT = 0.75
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    """The letter runs of a text in lower case."""
    return _WORD.findall(text.lower())


def grams(word: str) -> list[str]:
    """The n-grams of a word: each character (and the end) with the ``ORDER - 1`` before it, from padding on."""
    padded = "^" * (ORDER - 1) + word + "$"
    return [padded[k:k + ORDER] for k in range(len(word) + 1)]


def _shared(pool) -> dict:
    """Kneser-Ney probabilities of the pooled counts at order ``ORDER - 1``: {n-gram: P(last | rest)}, interpolated
    down to the uniform distribution, for every n-gram that ends a pooled one."""
    types = {g[1:]: 0 for g in pool}
    orders = [None] * ORDER  # orders[k]: continuation counts of k-grams
    longer = set(pool)
    for k in range(ORDER - 1, 0, -1):
        counts = Counter(g[1:] for g in longer)
        orders[k] = counts
        longer = set(counts)
    uniform = 1 / (len(orders[1]) + 1)
    tables: dict[int, dict] = {0: {}}
    for k in range(1, ORDER):
        total: Counter = Counter()
        kinds: Counter = Counter()
        for g, c in orders[k].items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        below = tables[k - 1]
        tables[k] = {g: (max(c - DISCOUNT, 0) + DISCOUNT * kinds[g[:-1]] * (below[g[1:]] if k > 1 else uniform))
                     / total[g[:-1]] for g, c in orders[k].items()}
    return {g: tables[ORDER - 1][g] for g in types}


class Model:
    """Log-likelihood differences per word from n-gram counts of both classes: {n-gram: (toxic, ordinary)}."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        base = _shared(counts)
        total, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for g, both in counts.items():
            for c in (0, 1):
                total[g[:-1]][c] += both[c]
                kinds[g[:-1]][c] += both[c] > 0
        rest = lambda h, c: DISCOUNT * kinds[h][c] / total[h][c] if total[h][c] else 1.0
        self.unseen = {h: math.log(rest(h, 0) / rest(h, 1)) for h in total}
        self.seen = {}
        for g, both in counts.items():
            h = g[:-1]
            p = [(max(both[c] - DISCOUNT, 0) / total[h][c] if total[h][c] else 0.0) + rest(h, c) * base[g[1:]]
                 for c in (0, 1)]
            self.seen[g] = math.log(p[0] / p[1])
        self.cache: dict[str, float] = {}

    def word(self, word: str) -> float:
        """LL(toxic) - LL(ordinary) of a word. An n-gram new to a known context costs both classes the same shared
        probability, times what each has left for new ones; in an unknown context nothing differs."""
        seen, unseen = self.seen, self.unseen
        return sum(seen[g] if g in seen else unseen.get(g[:-1], 0.0) for g in grams(word))

    def features(self, text: str | None) -> list[float]:
        """Length-normalised differences: of the whole text, then of the most toxic window of each length."""
        words = tokens(text or "")
        if not words:
            return [0.0] * (1 + len(WINDOWS))
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = self.word(w)
        x = np.fromiter(map(cache.__getitem__, words), float, len(words))
        sums = np.concatenate([[0.0], np.cumsum(x)])
        out = [sums[-1] / len(x)]
        for n in WINDOWS:
            m = min(n, len(x))
            out.append(float((sums[m:] - sums[:-m]).max()) / n)
        return out


def logistic(rows: DataFrame, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (last: intercept) of a logistic regression of ``label`` on the values of ``x``, by Newton's method. A step
    is one aggregate over all rows."""
    n = 2 + len(WINDOWS)
    x = [F.col("x")[k] for k in range(n - 1)] + [F.lit(1.0)]
    w = np.zeros(n)
    penalty = np.eye(n) * ridge
    penalty[-1, -1] = 1e-6
    upper = np.triu_indices(n)
    for _ in range(steps):
        at = sum(F.lit(float(v)) * c for v, c in zip(w, x))
        seen = rows.select(F.array(*x).alias("x"), "label", (
            1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), at))))).alias("p"))
        own = [F.col("x")[k] for k in range(n)]
        spread = F.col("p") * (1 - F.col("p")) + 1e-9
        sums = np.array(seen.agg(*[F.sum(spread * own[i] * own[j]) for i, j in zip(*upper)],
                                 *[F.sum(c * (F.col("label") - F.col("p"))) for c in own]).first(), float)
        curve = np.zeros((n, n))
        curve[upper] = sums[:-n]
        curve = curve + np.triu(curve, 1).T
        step = np.linalg.solve(curve + penalty, sums[-n:] - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def known_labels(labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, label, order) of the labelled ids that are not held out; ``order`` is the id's hash."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    return known.where(crc_remainder(F.col("doc_id"), modulus) != held).withColumn(
        "order", F.xxhash64("doc_id", F.lit(modulus)))


def fold_of(order: str) -> Column:
    return F.pmod(order, F.lit(FOLDS)).cast("int").alias("fold")


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """(text, label, fold) of all rows with a text whose id has a label and is not held out. Labels grow with the
    documents, so both are shuffled by id at every size; small labels are not broadcast."""
    known = known_labels(labels, label, modulus, held).select("doc_id", "label", fold_of("order"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    return texts.join(known.hint("merge"), "doc_id").select("text", "label", "fold")


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, size: int,
           balanced: bool = True) -> DataFrame:
    """(text, label, fold) of the training sample: the rows smallest by id hash, at most ``size`` of each class, or
    twice ``size`` of both in their own proportion. The chosen ids are broadcast; texts are not shuffled."""
    known = known_labels(labels, label, modulus, held)
    first = lambda rows, n: rows.orderBy("order", "doc_id").limit(n)
    best = first(known, 2 * size) if not balanced else first(known.where("label = 0"), size).unionByName(
        first(known.where("label = 1"), size))
    chosen = best.select("doc_id", "label", fold_of("order"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.length("text") <= SAMPLE_CHARS)
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label", "fold")


def count_grams(rows: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary, toxic_0, ordinary_0): n-gram counts of (text, label, fold) rows by class, of all folds and
    of fold 0. A task counts words, and turns them into n-grams when it holds ``CACHE`` of them."""
    names = ["toxic", "ordinary", "toxic_0", "ordinary_0"]

    def flush(words):
        tally: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        for (label, fold), counts in words.items():
            at = 0 if label == 1 else 1
            for w, n in counts.items():
                for g in grams(w):
                    both = tally[g]
                    both[at] += n
                    if fold == 0:
                        both[at + 2] += n
        return pa.RecordBatch.from_arrays(
            [pa.array(list(tally), pa.string()), *(pa.array([v[k] for v in tally.values()], pa.int64()) for k in range(4))],
            ["gram", *names])

    def count(batches):
        words = defaultdict(Counter)
        for b in batches:
            for text, label, fold in zip(*(b.column(k).to_pylist() for k in range(3))):
                words[label, min(fold, 1)].update(tokens(text))
            if sum(map(len, words.values())) > CACHE:
                yield flush(words)
                words.clear()
        if words:
            yield flush(words)

    return rows.select("text", "label", "fold").mapInArrow(
        count, "gram string, " + ", ".join(f"{c} long" for c in names)).groupBy("gram").agg(
        *[F.sum(c).alias(c) for c in names])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held: int = 2):
    """(model, weights) from all labelled rows that are not held out, or None without rows of both classes. The
    regression is fitted on fold 0, which a model of the other folds measures; the model returned is that of all folds."""
    rows = labelled(docs, labels, label, modulus, held)
    context = rows.sparkSession.sparkContext
    table = count_grams(rows).toArrow()
    found = list(zip(*(table.column(k).to_pylist() for k in range(5))))
    some = lambda counts: all(any(both[c] for both in counts.values()) for c in (0, 1))
    others = {g: (t - t0, o - o0) for g, t, o, t0, o0 in found if t + o > t0 + o0}
    if not some(others):
        return None
    measuring = context.broadcast(Model(others))

    def measure(batches):
        for b in batches:
            x = [measuring.value.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "label"])

    got = rows.where("fold = 0").select("text", "label").mapInArrow(measure, "x array<double>, label int").persist()
    try:
        weights = logistic(got) if got.select("label").distinct().count() == 2 else None
    finally:
        got.unpersist()
        measuring.unpersist()
    if weights is None:
        return None
    return context.broadcast(Model({g: (t, o) for g, t, o, *_ in found})), weights


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    fitted = fit(docs, labels)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "text")

    def run(batches):
        for b in batches:
            score = np.zeros(len(b))
            if fitted and len(b):
                model, w = fitted
                x = np.array([model.value.features(t.as_py()) for t in b.column(2)])
                score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
