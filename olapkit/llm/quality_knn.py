"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's term vector counts hashed words and trigrams of character classes (letters by case, digits, blanks, each mark),
adds how often a word or a line repeats an earlier one, and is damped, weighted by inverse document frequency and
normalised. A truncated SVD of the sample's vectors gives the latent space. The labelled vectors of the sample are
broadcast (``2 * SAMPLE`` rows of ``DIMENSIONS`` floats at most); for every document, blocks of cosines with all of them
are computed exactly, and the labels of the ``NEIGHBOURS`` nearest are averaged with their similarity as weight.

Fitting uses the bounded sample of ``toxicity.sample``, classes in their own proportion; every document is scored, whole. Labels and ids choose and mark
training rows; scores are made from texts alone.

Defined results: a text without terms (null, empty) has the zero vector, is similar to nothing, and gets the share of
label 1 in the sample. Ties among neighbours go to the earlier sample row (by id hash). Without labelled rows every score
is 0.5. Repeated rows score alike; a null id is not held out. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder
from .hashing import text_words
from .toxicity import SAMPLE, sample

DIMENSIONS, NEIGHBOURS, BLOCK, THRESHOLD = 32, 15, 512, 0.3
WORD_TERMS, CLASSES = 4096, 24
MARKS = b"#*$%&|<>!?.,;:\"'"
TERMS = WORD_TERMS + CLASSES ** 3 + 2


def _class_table() -> np.ndarray:
    """Byte -> class: blank, newline, lower, upper, digit, byte beyond ASCII, each mark, other."""
    t = np.full(256, 23, np.int64)
    t[[32, 9, 11, 12, 13]], t[10] = 0, 1
    t[97:123], t[65:91], t[48:58], t[128:] = 2, 3, 4, 5
    for k, c in enumerate(MARKS):
        t[c] = 6 + k
    return t


_CLASS = _class_table()


def term_vector(text: str | None, words: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of a text: damped counts of its terms. ``words``: hashes of its words."""
    if words is None or not len(words):
        return np.empty(0, np.int64), np.empty(0)
    c = _CLASS[np.frombuffer(text.encode(), np.uint8)]
    counts = np.zeros(TERMS)
    counts[:WORD_TERMS] = np.bincount((words >> np.uint64(52)).astype(np.int64), minlength=WORD_TERMS)
    if len(c) > 2:
        counts[WORD_TERMS:-2] = np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3)
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = np.array([len(words) - len(np.unique(words)), len(lines) - len(set(lines))], float)
    terms = np.flatnonzero(counts)
    # words and character classes weigh alike, whatever the length of the text
    size = np.where(terms < WORD_TERMS, len(words), max(1, len(c)))
    weights = np.sqrt(counts[terms] / size)
    some = np.flatnonzero(repeats)
    return (np.append(terms, TERMS - 2 + some),
            np.append(weights, np.sqrt(repeats / [len(words), max(1, len(lines))])[some]))


def _vectors(texts: pa.Array):
    words = dict(text_words(texts))
    for k, t in enumerate(texts):
        yield term_vector(t.as_py(), words.get(k))


class Space:
    """Latent space and labelled vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray):
        seen = np.zeros(TERMS)
        for terms, _ in vectors:
            seen[terms] += 1
        self.idf = np.log((1 + len(vectors)) / (1 + seen)) + 1
        kept = np.flatnonzero(seen >= 2)
        column = np.full(TERMS, -1)
        column[kept] = np.arange(len(kept))
        x = np.zeros((len(vectors), max(1, len(kept))), np.float32)
        for row, (terms, weights) in enumerate(vectors):
            at = column[terms]
            x[row, at[at >= 0]] = (weights * self.idf[terms])[at >= 0]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        # right singular vectors by a randomised range finder, seeded: k + 16 probes, two power steps
        k = min(DIMENSIONS, *x.shape)
        q = np.linalg.qr(x.T @ np.random.default_rng(0).standard_normal((len(x), min(k + 16, len(x)))).astype(np.float32))[0]
        for _ in range(2):
            q = np.linalg.qr(x.T @ (x @ q))[0]
        right = np.linalg.svd(x @ q, full_matrices=False)[2][:k]
        self.basis = np.zeros((TERMS, k), np.float32)
        self.basis[kept] = (q @ right.T)[:len(kept)]
        self.basis *= self.idf[:, None].astype(np.float32)
        self.points = self._unit(x @ (q @ right.T))
        self.labels = labels.astype(np.float64)
        self.share = float(labels.mean())

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Similarity-weighted votes for a block of texts."""
        x = np.zeros((len(vectors), self.basis.shape[1]), np.float32)
        for row, (terms, weights) in enumerate(vectors):
            if len(terms):
                x[row] = weights.astype(np.float32) @ self.basis[terms]
        cosines = self._unit(x) @ self.points.T
        n = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, n - 1, axis=1)[:, :n]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 0, votes / np.maximum(total, 1e-12), self.share).clip(0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held: int = 0) -> Space | None:
    """The space of the training sample. Term vectors are made in tasks; the sample's rows reach the driver."""
    rows = sample(docs, labels, label, modulus, held, SAMPLE, balanced=False)

    def run(batches):
        for b in batches:
            vectors = list(_vectors(b.column(0)))
            if vectors:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in vectors], pa.list_(pa.int64())),
                     pa.array([w for _, w in vectors], pa.list_(pa.float64())), b.column(1), b.column(2)],
                    ["terms", "weights", "label", "order"])

    got = rows.select("text", "label", F.xxhash64("text").alias("order")).mapInArrow(
        run, "terms array<long>, weights array<double>, label int, order long").toArrow()
    got = got.sort_by([("order", "ascending"), ("label", "ascending")])
    if not len(got):
        return None
    lists = lambda name, kind: [np.asarray(x.values, kind) for x in got[name].combine_chunks()]
    return Space(list(zip(lists("terms", np.int64), lists("weights", float))), got["label"].to_numpy())


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    space = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "text")

    def run(batches):
        for b in batches:
            parts, texts = [np.empty(0)], b.column(2)
            for at in range(0, len(b), BLOCK):
                block = texts.slice(at, BLOCK)
                if space.value is None:
                    parts.append(np.full(len(block), 0.5))
                else:
                    parts.append(space.value.scores(list(_vectors(block))))
            score = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
