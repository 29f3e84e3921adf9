"""A stored cube as a lattice of cuboids (O-O8): some groupings are stored, the others are answered from these.

* **Choice.** The sizes of all groupings of the levels are estimated from the distinct cells of the finest one, which one
  pass over the facts gives. The finest grouping is always stored. Further ones are chosen greedily by their benefit: the rows that all groupings they can answer no longer
  have to read. A grouping that holds a level also holds the levels it determines (``implies``: a city's country), so it
  answers those too.
* **Cells.** A cell holds the sum and the number of the measure, and a mergeable sketch of a column's distinct values.
  Sums, numbers and sketches of coarser groupings are those of stored cells put together, so no answer reads the facts.
* **Deltas.** New facts (a day of sales) are grouped once at the finest level; the deltas of the coarser cuboids come from
  that. Every delta is appended to its cuboid as a batch with a name, published once; the batch counts when it is in all
  cuboids. So a refresh costs what the delta costs, a repeated one changes nothing, and one that was killed half way is
  finished by its repetition. ``compact`` sums the batches of a cuboid up.

Facts that are taken back come as a delta of negative measures with ``weight`` -1; sketches keep what they have seen.
Sums of decimals are exact. NULL levels are values. The number of levels is small (2^n groupings are sized at once).
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.writers import append_batch, read_batches

#: log2 of a sketch's size: 4,096 registers, a standard error of some 1.6 %.
SKETCH_BITS, MOST_LEVELS = 12, 10
#: Groups that a task keeps as sketches in memory (some 5 KB each at most) before it sorts its rows by group.
GROUPS_IN_MEMORY = 1 << 14
_FALLBACK = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def closure(levels: Iterable[str], implies: Mapping[str, Sequence[str]]) -> frozenset[str]:
    """The levels and all that they determine."""
    out, todo = set(), list(levels)
    while todo:
        level = todo.pop()
        if level not in out:
            out.add(level)
            todo += implies.get(level, ())
    return frozenset(out)


def groupings(levels: Sequence[str]) -> list[frozenset[str]]:
    return [frozenset(g) for g in chain.from_iterable(combinations(levels, n) for n in range(len(levels) + 1))]


def choose(sizes: Mapping[frozenset[str], int], implies: Mapping[str, Sequence[str]], n: int) -> list[frozenset[str]]:
    """The finest grouping and up to ``n`` more, each with the largest benefit beside those before it (ties: fewer levels,
    then their names)."""
    finest = max(sizes, key=len)
    taken = [finest]
    covers = {v: [w for w in sizes if w <= closure(v, implies)] for v in sizes}
    cost = {w: sizes[finest] for w in sizes}
    for _ in range(n):
        gain = {v: sum(max(0, cost[w] - sizes[v]) for w in covers[v]) for v in sizes if v not in taken}
        best = min(gain, key=lambda v: (-gain[v], len(v), sorted(v)), default=None)
        if best is None or gain[best] <= 0:
            break
        taken.append(best)
        for w in covers[best]:
            cost[w] = min(cost[w], sizes[best])
    return taken


def grouping_sizes(facts: DataFrame, levels: Sequence[str]) -> dict[frozenset[str], int]:
    """Estimated cells of all groupings. Facts are made distinct at the finest grouping first: a row adds to an estimate
    only the first time its cell is met, so 2^n estimates see each cell once and not every fact."""
    sets = groupings(levels)
    tell = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))
    cells = [F.approx_count_distinct(F.xxhash64(*[tell(c) for c in sorted(g)])).alias(f"g{i}")
             for i, g in enumerate(sets) if g]
    row = facts.select(*levels).distinct().agg(*cells).first()
    return {g: int(row[f"g{i}"]) if g else 1 for i, g in enumerate(sets)}


@contextlib.contextmanager
def sketches_in_memory(spark: SparkSession) -> Iterator[None]:
    """Sketches of up to ``GROUPS_IN_MEMORY`` groups a task are aggregated without a sort (Spark's own bound is 128), unless
    the session has a bound of its own."""
    own = _FALLBACK in spark.conf.getAll
    if not own:
        spark.conf.set(_FALLBACK, str(GROUPS_IN_MEMORY))
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(_FALLBACK)


class CubeLattice:
    """Stored cuboids of a measure over some levels, under a shared folder."""

    def __init__(self, spark: SparkSession, path: str, levels: Sequence[str], measure: str, distinct: str,
                 implies: Mapping[str, Sequence[str]] | None = None):
        if not 0 < len(levels) <= MOST_LEVELS:
            raise ValueError(f"a lattice has 1 to {MOST_LEVELS} levels")
        self.spark, self.path, self.levels = spark, path.rstrip("/"), list(levels)
        self.measure, self.distinct, self.implies = measure, distinct, dict(implies or {})
        self.cuboids: dict[frozenset[str], str] = {}
        self.sizes: dict[frozenset[str], int] = {}
        self.types: T.StructType | None = None

    # ---- building
    def plan(self, facts: DataFrame, n: int) -> list[frozenset[str]]:
        """Choose the cuboids from the facts' sizes; to be called once, before the first ``add``."""
        self.sizes = grouping_sizes(facts, self.levels)
        picked = choose(self.sizes, self.implies, n)
        self.cuboids = {g: f"{self.path}/{'-'.join(sorted(g)) or 'all'}-{uuid.uuid4().hex[:8]}" for g in picked}
        self.types = facts.select(*self.levels).schema
        return picked

    def _columns(self, g: frozenset[str]) -> list[str]:
        return [c for c in self.levels if c in closure(g, self.implies)]

    def _schema(self, g: frozenset[str]) -> T.StructType:
        own = [T.StructField(c, self.types[c].dataType) for c in self._columns(g)]
        return T.StructType([*own, T.StructField("total", T.DecimalType(38, 2)), T.StructField("n", T.LongType()),
                             T.StructField("sketch", T.BinaryType())])

    _DONE = T.StructType([T.StructField("name", T.StringType())])

    def add(self, facts: DataFrame, batch: str, weight: int = 1) -> bool:
        """Add facts as a batch; False if it was there already."""
        if not self.cuboids:
            raise ValueError("plan the lattice first")
        if batch in self.batches():
            return False
        finest, *others = self.cuboids
        measure = F.col(self.measure).cast("decimal(38,2)")
        cells = facts.groupBy(*self._columns(finest)).agg(
            F.sum(measure).alias("total"), (F.count(F.lit(1)) * weight).alias("n"),
            F.hll_sketch_agg(F.col(self.distinct).cast("string"), SKETCH_BITS).alias("sketch"))
        with sketches_in_memory(self.spark):
            append_batch(cells, self._schema(finest), self.cuboids[finest], batch)
        top = read_batches(self.spark, self._schema(finest), self.cuboids[finest], names=True).where(
            F.col("_batch") == batch).drop("_batch")
        for g in others:
            append_batch(top.groupBy(*self._columns(g)).agg(*self._together()), self._schema(g), self.cuboids[g], batch)
        return append_batch(self.spark.createDataFrame([(batch,)], self._DONE), self._DONE, f"{self.path}/done", batch)

    @staticmethod
    def _together() -> list[Column]:
        return [F.sum("total").cast("decimal(38,2)").alias("total"), F.sum("n").alias("n"),
                F.hll_union_agg("sketch").alias("sketch")]

    def batches(self) -> list[str]:
        """Names of the batches that are in all cuboids (compactions are batches too)."""
        rows = read_batches(self.spark, self._DONE, f"{self.path}/done").collect()
        return sorted(r.name for r in rows)

    # ---- answering
    def source(self, levels: Iterable[str]) -> frozenset[str]:
        """The smallest stored cuboid that answers a grouping."""
        levels = frozenset(levels)
        fit = [g for g in self.cuboids if levels <= closure(g, self.implies)]
        if not fit:
            raise KeyError(f"unknown levels {sorted(levels - set(self.levels))}; known: {self.levels}")
        return min(fit, key=lambda g: (self.sizes[g], sorted(g)))

    def cells(self, g: frozenset[str]) -> DataFrame:
        """The published cells of a stored cuboid, one or more rows for each (one a batch)."""
        rows = read_batches(self.spark, self._schema(g), self.cuboids[g], names=True)
        return rows.where(F.col("_batch").isin(self.batches())).drop("_batch")

    def answer(self, *levels: str, where: Column | None = None) -> DataFrame:
        """A grouping with ``total``, ``n`` and the estimate ``distinct``, from the smallest cuboid; ``where`` may name the
        levels of the grouping. Cells without facts left (n = 0) are not returned."""
        cells = self.cells(self.source(levels))
        cells = cells.where(where) if where is not None else cells
        out = cells.groupBy(*levels).agg(*self._together()).where("n <> 0")
        return out.select(*levels, "total", "n", F.hll_sketch_estimate("sketch").alias("distinct"))

    def compact(self) -> None:
        """Write every cuboid's cells anew, one row for each, as one batch of a new folder. The names of the batches in it
        stay known, so none is added again."""
        name = f"sum-{uuid.uuid4().hex}"
        fresh = {g: f"{self.path}/{'-'.join(sorted(g)) or 'all'}-{uuid.uuid4().hex[:8]}" for g in self.cuboids}
        for g, path in fresh.items():
            cells = self.cells(g).groupBy(*self._columns(g)).agg(*self._together())
            append_batch(cells, self._schema(g), path, name)
        append_batch(self.spark.createDataFrame([(name,)], self._DONE), self._DONE, f"{self.path}/done", name)
        self.cuboids = fresh
