"""OLAP operations over a star: cube query, slice, dice, roll-up, drill-down,
grouping sets, cube and the naive union of groupings (O-O*, O-A13..O-A15).

A ``CubeQuery`` names *levels* (``day``, ``rating``, ``city`` ...), each an
attribute of one dimension. ``frame()`` joins the fact only with the
dimensions that the grouping or the filters touch; filters are applied to
the dimension before the join, so Catalyst pushes them into the dimension
scan and, for a partitioned fact, can prune fact partitions dynamically.
Every grouping variant is one aggregation: ``GROUPING SETS`` and ``CUBE``
become an ``Expand`` feeding a single partial + final hash aggregate, so the
fact is scanned once however many groupings are asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .star import REVENUE, Star, year_key

PRUNE_KEY = "year_key"


@dataclass(frozen=True)
class Level:
    dim: str          # dimension name in the star (date, customer, item, store)
    column: str       # attribute column in that dimension


@dataclass(frozen=True)
class DimRef:
    fact_key: str
    dim_key: str


# Levels of the sales star; names follow the reference's attribute names.
STAR_LEVELS = {
    "date": Level("date", "date"),
    "year": Level("date", "year"),
    "quarter": Level("date", "quarter"),
    "month": Level("date", "month"),
    "day": Level("date", "day"),
    "week": Level("date", "week"),
    "is_weekend": Level("date", "is_weekend"),
    "title": Level("item", "title"),
    "rating": Level("item", "rating"),
    "brand": Level("item", "brand"),
    "city": Level("customer", "city"),
    "country": Level("customer", "country"),
    "district": Level("customer", "district"),
    "store_city": Level("store", "city"),
    "store_country": Level("store", "country"),
}

STAR_DIMS = {
    "date": DimRef("date_key", "date_key"),
    "customer": DimRef("customer_key", "customer_key"),
    "item": DimRef("item_key", "item_key"),
    "store": DimRef("store_key", "store_key"),
}


@dataclass(frozen=True)
class CubeQuery:
    star: Star
    group: tuple[str, ...] = ()
    filters: tuple[tuple[str, tuple], ...] = ()
    measure: str = "sales_amount"
    measure_name: str = "revenue"
    result_type: str = REVENUE
    levels: dict = field(default_factory=lambda: dict(STAR_LEVELS))
    dims: dict = field(default_factory=lambda: dict(STAR_DIMS))

    # ---- building the query -------------------------------------------------
    def by(self, *levels: str) -> CubeQuery:
        self._check(levels)
        return replace(self, group=tuple(levels))

    def slice(self, level: str, value) -> CubeQuery:
        """Fix one dimension attribute to a single value."""
        return self.dice({level: [value]})

    def dice(self, selection: dict[str, Iterable]) -> CubeQuery:
        """Keep a sub-cube: several values on one or more attributes."""
        self._check(selection)
        add = tuple((lv, tuple(vals)) for lv, vals in selection.items())
        return replace(self, filters=self.filters + add)

    def rollup_to(self, level: str, parent: str) -> CubeQuery:
        """Group at a coarser level of the same dimension (city -> country)."""
        return self._swap(level, parent)

    def drill_to(self, level: str, child: str) -> CubeQuery:
        """Group at a finer level of the same dimension (city -> district)."""
        return self._swap(level, child)

    # ---- running it ------------------------------------------------------------
    def joined(self, extra_levels: Sequence[str] = ()) -> DataFrame:
        """Fact joined with the dimensions the query needs, level columns named."""
        needed = list(dict.fromkeys([*self.group, *extra_levels, *(lv for lv, _ in self.filters)]))
        by_dim: dict[str, list[str]] = {}
        for lv in needed:
            by_dim.setdefault(self.levels[lv].dim, []).append(lv)
        df = self.star.fact
        for dim, lvls in by_dim.items():
            ref = self.dims[dim]
            ddf = getattr(self.star, dim)
            cols = [F.col(ref.dim_key).alias(ref.fact_key)]
            keys = [ref.fact_key]
            if dim == "date" and PRUNE_KEY in df.columns:
                # stored fact partitioned by year: joining on it too lets a
                # date filter prune fact partitions (dynamic partition pruning)
                cols.append(year_key(ref.dim_key).alias(PRUNE_KEY))
                keys.append(PRUNE_KEY)
            cols += [F.col(self.levels[lv].column).alias(lv) for lv in lvls]
            ddf = ddf.select(*cols)
            for lv, vals in self.filters:
                if lv in lvls:
                    ddf = ddf.filter(F.col(lv).isin(list(vals)))
            df = df.join(ddf, keys)
        return df

    def _agg(self) -> Column:
        return F.sum(self.measure).cast(self.result_type).alias(self.measure_name)

    def frame(self) -> DataFrame:
        """One grouping: ``GROUP BY`` the chosen levels."""
        return self.joined().groupBy(*self.group).agg(self._agg())

    def top(self, n: int) -> DataFrame:
        """Top-n groups by measure; level values break ties so the answer repeats."""
        return (self.frame()
                .orderBy(F.desc(self.measure_name), *[F.asc_nulls_last(c) for c in self.group])
                .limit(n))

    def grouping_sets(self, sets: Sequence[Sequence[str]], with_id: bool = False) -> DataFrame:
        """Several groupings in one pass (``GROUP BY GROUPING SETS``)."""
        cols = list(dict.fromkeys(c for s in sets for c in s))
        self._check(cols)
        aggs = [self._agg()]
        if with_id:
            aggs.append(F.grouping_id(*cols).alias("grouping_id"))
        return (self.joined(cols)
                .groupingSets([[F.col(c) for c in s] for s in sets], *cols)
                .agg(*aggs))

    def cube(self, *levels: str, with_id: bool = False) -> DataFrame:
        """All 2^n groupings of the levels (``GROUP BY CUBE``)."""
        self._check(levels)
        aggs = [self._agg()]
        if with_id:
            aggs.append(F.grouping_id(*levels).alias("grouping_id"))
        return self.joined(levels).cube(*levels).agg(*aggs)

    def naive_union(self, *levels: str, as_text: Iterable[str] = ()) -> DataFrame:
        """The same groupings as ``cube`` written as one query per grouping
        combined with ``UNION ALL`` (the slow form the reference compares
        against). Columns in ``as_text`` are emitted as strings."""
        as_text = set(as_text)
        n = len(levels)
        parts = []
        for mask in range(1 << n):
            keep = [lv for i, lv in enumerate(levels) if mask & (1 << (n - 1 - i))]
            q = replace(self, group=tuple(keep)).frame()
            sel = []
            for lv in levels:
                typ = "string" if lv in as_text else None
                c = F.col(lv) if lv in keep else F.lit(None)
                if typ:
                    c = c.cast(typ)
                sel.append(c.alias(lv))
            parts.append(q.select(*sel, self.measure_name))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # ---- helpers -------------------------------------------------------------------
    def _check(self, levels: Iterable[str]) -> None:
        bad = [lv for lv in levels if lv not in self.levels]
        if bad:
            raise KeyError(f"unknown levels {bad}; known: {sorted(self.levels)}")

    def _swap(self, level: str, other: str) -> CubeQuery:
        self._check([level, other])
        if self.levels[level].dim != self.levels[other].dim:
            raise ValueError(f"{level} and {other} belong to different dimensions")
        return replace(self, group=tuple(other if g == level else g for g in self.group))


def cube_query(star: Star, *levels: str, measure: str = "sales_amount") -> CubeQuery:
    return CubeQuery(star=star, measure=measure).by(*levels)


def materialize_cube(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Store a computed cube (with its ``grouping_id``) as parquet, partitioned
    by grouping so a query for one grouping reads one directory."""
    part = ["grouping_id"] if "grouping_id" in df.columns else []
    w = df.write.mode(mode)
    if part:
        w = w.partitionBy(*part)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
