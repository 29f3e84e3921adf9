"""Vector bin packing of token sequences by the dot-product heuristic.

Every sequence has three limits at once: tokens, segments (pieces) and loss-bearing tokens. An example demands a vector
of these; the open sequence has a vector of what is left. Of the examples in a bounded window that fit, the one with
the largest dot product of demand and remainder is placed, so that an example heavy in what is plentiful comes first.
When none fits, the example with the largest dot product is cut and its head fills the sequence. Texts longer than a
sequence give whole sequences first; only their ends enter the window.

Each task packs the rows it reads, without a shuffle: a document's ids never leave the task, and a repeated task gives
the same sequences. What is left at the end of a partition is packed into sequences whose lengths are powers of two,
which need no padding. Sequence ids hold the partition number in the upper bits.

Defined results: a null or empty text is one token (the end id). Null ids, repeated rows and ties (the earlier row
first) are packed like other rows; no rows give no pieces. Only the id and text (and prompt) columns are read. Texts
are tokenized whole, in slices.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import encoder

END_ID = 1
MAX_TOKENS, MAX_SEGMENTS, WINDOW = 2048, 256, 256
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "loss_tokens long, segment int")


class Packer:
    """Packs examples one after another; ``add`` and ``finish`` return finished pieces.

    A piece is (example, start, length, offset, loss tokens, segment, sequence)."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None,
                 window: int = WINDOW):
        self.limits = np.array([max_tokens, max_segments, max_tokens if max_loss is None else max_loss], float)
        if self.limits.min() < 1:
            raise ValueError("every limit must be at least 1")
        self.window, self.sequences = window, 0
        self.keys: list = []  # examples in the window, in order of arrival
        self.demand = np.empty((0, 3))
        self.span = np.empty((0, 3), np.int64)  # next token, all tokens, first loss-bearing token

    def _row(self, span) -> list[float]:
        at, end, loss = span
        return [end - at, 1, max(0, end - max(at, loss))]

    def add(self, key, tokens: int, prompt_tokens: int = 0) -> list[tuple]:
        """Take an example of ``tokens`` tokens of which the first ``prompt_tokens`` bear no loss."""
        out, span = [], [0, tokens, prompt_tokens]
        while span[0] < tokens and (np.array(self._row(span)) >= self.limits)[[0, 2]].any():
            n = self._head(span, self.limits)
            out.append((*self._piece(key, span, n, 0, 0), self.sequences))
            self.sequences += 1
            span[0] += n
        if span[0] < tokens:
            self.keys.append(key)
            self.demand = np.vstack([self.demand, self._row(span)])
            self.span = np.vstack([self.span, span])
        while len(self.keys) >= self.window:
            out += self._fill(self.limits)
        return out

    def finish(self) -> list[tuple]:
        """Pack the rest: full sequences while there are enough tokens, then lengths of powers of two."""
        out = []
        while self.keys:
            tokens, limits = int(self.demand[:, 0].sum()), self.limits.copy()
            if tokens < limits[0]:
                limits[0] = 1 << (tokens.bit_length() - 1)
            out += self._fill(limits)
        return out

    @staticmethod
    def _head(span, left) -> int:
        """How many tokens of an example fit: bounded by tokens, and by loss-bearing tokens behind its prompt."""
        at, end, loss = span
        return int(min(end - at, left[0], max(0, loss - at) + left[2]))

    @staticmethod
    def _piece(key, span, n, sequence_offset, segment) -> tuple:
        at, _, loss = span
        return (key, int(at), int(n), int(sequence_offset), int(max(0, at + n - max(at, loss))), segment)

    def _fill(self, limits: np.ndarray) -> list[tuple]:
        left, out, offset = limits.copy(), [], 0
        while self.keys and left[0] >= 1 and left[1] >= 1:
            score = self.demand @ (left / limits / limits)
            fits = (self.demand <= left).all(axis=1)
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                n = int(self.demand[k, 0])
            else:
                k = int(np.argmax(score))
                n = self._head(self.span[k], left)
                if n < 1:  # loss-bearing tokens are used up: an example with a prompt left can still give some
                    heads = np.minimum(left[0], np.maximum(0, self.span[:, 2] - self.span[:, 0]))
                    k = int(np.argmax(heads))
                    n = int(heads[k])
                    if n < 1:
                        break
            piece = self._piece(self.keys[k], self.span[k], n, offset, len(out))
            out.append(piece)
            offset += n
            left -= [n, 1, piece[4]]
            self.span[k, 0] += n
            if self.span[k, 0] == self.span[k, 1]:
                del self.keys[k]
                self.demand, self.span = np.delete(self.demand, k, 0), np.delete(self.span, k, 0)
            else:
                self.demand[k] = self._row(self.span[k])
        done = [(*p, self.sequences) for p in out]
        self.sequences += 1
        return done


def pack(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss: int | None = None, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
         prompt: str | None = None) -> DataFrame:
    """Pieces of all rows: which ids of which row stand where in which sequence (see ``SCHEMA``).

    The ids of a row are those of its prompt (no loss), its text and ``END_ID``. ``vocabulary`` is a path that all
    executors have (a file of an installed package)."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")]
    cols.append((F.col(prompt) if prompt else F.lit(None)).cast("string").alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, packer = encoder(vocabulary), Packer(max_tokens, max_segments, max_loss, window)
        top = TaskContext.get().partitionId() << 40
        rows: dict[int, tuple] = {}
        out: list[tuple] = []

        def took(pieces):
            for key, at, n, offset, loss, segment, sequence in pieces:
                doc_id, ids = rows[key]
                out.append((doc_id, at, n, zlib.crc32(ids[at:at + n].astype("<u4").tobytes()), len(ids),
                            top + sequence, offset, loss, segment))
                left[key] -= n
                if not left[key]:
                    del rows[key], left[key]

        def batch() -> pa.RecordBatch:
            types = [pa.int64()] * 8 + [pa.int32()]
            cols = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in SCHEMA.split(", ")])

        key, left = 0, {}
        for b in batches:
            ids_in, texts, prompts = (b.column(i) for i in range(3))
            for doc_id, text, prompt in zip(ids_in, texts, prompts):
                head = enc.encode(prompt.as_py())
                ids = np.concatenate([head, enc.encode(text.as_py()), np.array([END_ID], np.uint32)])
                rows[key], left[key] = (doc_id.as_py(), ids), len(ids)
                took(packer.add(key, len(ids), len(head)))
                key += 1
                if len(out) >= 10_000:
                    yield batch()
        took(packer.finish())
        if out:
            yield batch()

    return docs.select(*cols).mapInArrow(run, SCHEMA)


def padded_length(length: int, max_tokens: int = MAX_TOKENS) -> int:
    """A sequence's length with padding: none at a power of two, else up to ``max_tokens``."""
    return length if length & (length - 1) == 0 else max_tokens


def report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Pieces of all documents, all of whose tokens bear loss."""
    return pack(docs, vocabulary)
