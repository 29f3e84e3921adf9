"""Exact top-k by inner product without random access (NRA).

For every dimension the candidates of a block form a list sorted by value; a query reads it downwards where its own
component is positive and upwards where it is negative. After each depth of sequential reading a candidate's score lies
between two bounds: components read count as they are, unread ones at most as the last value read and at least as the
list's end. Reading stops when all but a few candidates have an upper bound below the k-th lower bound; the
final scores of those few are resolved. Bounds of a group of queries with a block are four matrix products per depth.

Vectors are turned into whole numbers (``floor(scale * x)`` in doubles). Rows are dealt evenly into blocks of
``CANDIDATES`` and groups of ``QUERY_GROUP`` queries by their place, not by a key, so equal vectors or ids do not meet
in one task; a cell (query group, block) has a bounded size, every block sees every query, and the winners of all blocks
are merged per query.

Defined results: a row takes no part if its id or vector is null or a component is null or not finite; vectors meet only
vectors of the same length. A query is a row whose id is divisible by ``EVERY``; rows of its own id are no candidates.
Equal scores rank by the smaller id; repeated rows are candidates each, and each repeated query row has its own result
under its id. Fewer than k candidates are all returned. An empty table gives an empty result. Only the id and vector
columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K, EVERY, SCALE = 20, 20, 64
QUERY_GROUP, CANDIDATES, ROWS = 2048, 8192, 128
#: Depths of reading, as shares of the lists, and the number of open candidates (in k) at which reading stops.
DEPTHS, OPEN = (0.125, 0.25, 0.5, 0.75, 1.0), 16
#: Larger whole numbers leave a vector out of doubles' exact range; such vectors are refused.
LARGEST = 2.0 ** 53


def codes(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, size, codes): whole-number vectors of the rows that take part."""
    valid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    limit = LARGEST / scale
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = valid.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good)
    whole = F.transform("v", lambda x: F.when(F.abs(x) < limit, F.floor(x * float(scale))).otherwise(
        F.raise_error(F.lit("a component is too large for exact scores")).cast("long")))
    return valid.select("vec_id", F.size("v").alias("size"), whole.alias("codes"))


def _kind(q: np.ndarray, x: np.ndarray):
    """The cheapest number type in which every bound is exact."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else object


def top_block(ids: np.ndarray, q: np.ndarray, cand: np.ndarray, x: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's k best in a block, by NRA."""
    kind, n = _kind(q, x), len(x)
    lists = np.sort(x, axis=0)
    q, xs, lists = q.astype(kind), x.astype(kind), lists.astype(kind)
    order = np.argsort(cand, kind="stable")
    left, right = (np.searchsorted(cand[order], ids, side) for side in ("left", "right"))
    out = []
    for at in range(0, len(q), ROWS):
        rows = np.arange(at, min(at + ROWS, len(q)))
        for depth in DEPTHS:
            t = min(n, max(1, int(np.ceil(depth * n))))
            high, low = lists[n - t], lists[t - 1]
            up, down = np.maximum(q[rows], 0), np.minimum(q[rows], 0)
            upper = up @ np.maximum(xs, high).T + down @ np.minimum(xs, low).T
            lower = up @ np.where(xs >= high, xs, lists[0]).T + down @ np.where(xs <= low, xs, lists[-1]).T
            own = np.zeros(upper.shape, bool)
            for r, i in enumerate(rows):
                own[r, order[left[i]:right[i]]] = True
            if kind is object:
                best = np.sort(np.where(own, -(1 << 200), lower), axis=1)[:, max(0, n - k)]
            else:
                best = np.partition(np.where(own, -np.inf, lower), max(0, n - k), axis=1)[:, max(0, n - k)]
            open_ = (upper >= best[:, None]) & ~own
            done = (open_.sum(axis=1) <= OPEN * k) | (t == n)
            for r in np.flatnonzero(done):
                c = np.flatnonzero(open_[r])
                score = (xs[c] @ q[rows[r]]).astype(object if kind is object else np.int64)
                first = np.lexsort((cand[c], -score))[:k] if kind is not object else sorted(
                    range(len(c)), key=lambda j: (-score[j], cand[c[j]]))[:k]
                out += [(rows[r], c[j], int(score[j])) for j in first]
            rows = rows[~done]
            if not len(rows):
                break
    return out


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(
        [c.flatten() for c in flat.chunks])
    return flat.to_numpy().reshape(-1, size)


def top(vectors: DataFrame, k: int = K, every: int = EVERY, group: int = QUERY_GROUP,
        block: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries in ``codes`` output."""
    table = stored(vectors, "topk-codes").withColumn("place", F.monotonically_increasing_id())
    n = table.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    groups, blocks = max(1, -(-n[1] // group)), max(1, -(-n[0] // block))
    deal = lambda parts: F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int")
    numbers = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    queries = table.where(F.col("vec_id") % every == 0).select(
        "size", deal(groups).alias("g"), numbers(blocks).alias("b"), "place", "vec_id", "codes")
    candidates = table.select("size", deal(blocks).alias("b"), numbers(groups).alias("g"), "vec_id", "codes")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            size = left["size"][0].as_py()
            ids, places, cand = left["vec_id"].to_numpy(), left["place"].to_numpy(), right["vec_id"].to_numpy()
            if size:
                out = top_block(ids, _matrix(left["codes"], size), cand, _matrix(right["codes"], size), k)
            else:
                out = [(i, j, 0) for i in range(len(ids)) for j in [
                    c for c in np.argsort(cand, kind="stable")[:k + 1 + int((cand == ids[i]).sum())]
                    if cand[c] != ids[i]][:k]]
            out = [(places[i], ids[i], cand[j], s) for i, j, s in out]
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["place", "query_id", "vec_id", "score"])

    found = queries.groupBy("size", "g", "b").cogroup(candidates.groupBy("size", "g", "b")).applyInArrow(
        cell, "place long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame) -> DataFrame:
    """The 20 best of all embeddings for every embedding whose id is divisible by 20."""
    return top(codes(embeddings))


OP4_SQL = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM e),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
             coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
k AS (SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20"""
