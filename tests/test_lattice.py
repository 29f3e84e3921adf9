"""Cuboid lattice: choice, answers, deltas."""

import collections
import decimal
import itertools
import random

import pytest
from pyspark.sql import functions as F

from olapkit.operators import lattice
from olapkit.operators.lattice import CubeLattice, choose, groupings

from .conftest import plan_text, rows_of

LEVELS = ["city", "country", "month"]
IMPLIES = {"city": ["country"]}


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(600):
        city = rng.choice(["a", "b", "c", None])
        rows.append((city, {"a": "X", "b": "X", "c": "Y"}.get(city), rng.randint(1, 4), decimal.Decimal(rng.randint(-99, 999)) / 100,
                     rng.randint(0, 200)))
    return spark.createDataFrame(rows, "city string, country string, month int, amount decimal(12,2), buyer long")


def want(df, levels):
    out = collections.defaultdict(lambda: [decimal.Decimal(0), 0])
    for r in df.collect():
        cell = out[tuple(r[c] for c in levels)]
        cell[0] += r.amount
        cell[1] += 1
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def got(cube, *levels):
    return sorted((tuple(r)[:-1] for r in cube.answer(*levels).collect()), key=str)


@pytest.mark.parametrize("n", [0, 2, 7])
def test_answers_deltas_and_compaction(spark, tmp_dir, facts, n):
    cube = CubeLattice(spark, f"{tmp_dir}/c", LEVELS, "amount", "buyer", IMPLIES)
    with pytest.raises(ValueError):
        cube.add(facts, "x")
    cube.plan(facts, n)
    first, second = facts.where("month < 3"), facts.where("month >= 3")
    assert cube.add(first, "1") and not cube.add(first, "1") and cube.add(second, "2")
    every = [list(g) for k in range(4) for g in itertools.combinations(LEVELS, k)]
    for g in every:
        assert got(cube, *g) == want(facts, g), g
    assert rows_of(cube.answer("country", where=F.col("country") == "X").select("n")) == [(facts.where("country = 'X'").count(),)]
    cube.compact()
    assert not cube.add(second, "2")                        # known after a compaction too
    for g in every[::3]:
        assert got(cube, *g) == want(facts, g)
    # facts that are taken back
    gone = second.where("city = 'c'").withColumn("amount", -F.col("amount"))
    assert cube.add(gone, "3", weight=-1)
    left = facts.where("NOT (month >= 3 AND city <=> 'c')")
    for g in every:
        assert got(cube, *g) == want(left, g)
    with pytest.raises(KeyError):
        cube.answer("planet")


def test_a_killed_delta_counts_only_when_repeated(spark, tmp_dir, facts, monkeypatch):
    cube = CubeLattice(spark, f"{tmp_dir}/c", LEVELS, "amount", "buyer", IMPLIES)
    cube.plan(facts, 2)
    cube.add(facts.where("month = 1"), "1")
    real, calls = lattice.append_batch, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(*args)

    monkeypatch.setattr(lattice, "append_batch", dies)
    with pytest.raises(RuntimeError):
        cube.add(facts.where("month = 2"), "2")
    monkeypatch.setattr(lattice, "append_batch", real)
    assert cube.batches() == ["1"] and got(cube, "month") == want(facts.where("month = 1"), ["month"])
    assert cube.add(facts.where("month = 2"), "2")
    for g in (["month"], ["country"], [], ["city", "month"]):
        assert got(cube, *g) == want(facts.where("month <= 2"), g)


def test_a_delta_costs_its_own_cells(spark, tmp_dir, facts):
    cube = CubeLattice(spark, f"{tmp_dir}/c", LEVELS, "amount", "buyer", IMPLIES)
    cube.plan(facts, 1)
    cube.add(facts, "all")
    one = facts.limit(1)
    cube.add(one, "day")
    for g in cube.cuboids:
        rows = lattice.read_batches(spark, cube._schema(g), cube.cuboids[g], names=True).where("_batch = 'day'")
        assert rows.count() == 1


def test_sketches_are_near_and_merge(spark, tmp_dir):
    big = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("city"), F.lit("X").alias("country"),
                                     (F.col("id") % 5).cast("int").alias("month"), F.lit(1).cast("decimal(12,2)").alias("amount"),
                                     (F.col("id") % 20_011).alias("buyer"))
    cube = CubeLattice(spark, f"{tmp_dir}/c", LEVELS, "amount", "buyer", IMPLIES)
    cube.plan(big, 2)
    cube.add(big.where("month < 2"), "1")
    cube.add(big.where("month >= 2"), "2")
    for levels in ([], ["month"], ["city", "month"]):
        exact = {tuple(r[c] for c in levels): r.n for r in big.groupBy(*levels).agg(F.count_distinct("buyer").alias("n")).collect()}
        for r in cube.answer(*levels).collect():
            true = exact[tuple(r[c] for c in levels)]
            assert abs(r.distinct - true) <= 0.08 * true


def test_choice_is_greedy_by_benefit():
    sizes = dict(zip(groupings(["a", "b"]), [1, 10, 90, 100]))
    assert choose(sizes, {}, 9)[:2] == [frozenset("ab"), frozenset("a")]
    assert choose(sizes, {}, 0) == [frozenset("ab")]
    # what a level determines is answered by it too
    city, land = frozenset(["city"]), frozenset(["land"])
    sizes = {frozenset(): 1, city: 50, land: 5, city | land: 60}
    assert choose(sizes, {"city": ["land"]}, 2) == [city | land, land, city]
    assert choose(sizes, {}, 2) == [city | land, land, city] and choose(sizes, {"city": ["land"]}, 1) == [city | land, land]
    rng = random.Random(1)
    for _ in range(20):
        sizes = {g: rng.randint(1, 5 ** len(g)) for g in groupings("abcd")}
        taken, cost = choose(sizes, {}, 3), lambda v: sum(min(sizes[t] for t in v if w <= t) for w in sizes)  # noqa: E731,B023
        top = taken[0]
        best = min((cost([top, v]) for v in sizes), default=0)
        assert len(taken) == 1 or cost(taken[:2]) == best


def test_sizes_are_estimated_from_distinct_cells(facts, monkeypatch):
    monkeypatch.setattr(lattice.F, "approx_count_distinct", F.count)   # the rows that an estimate sees
    cells = facts.select(*LEVELS).distinct().count()
    sizes = lattice.grouping_sizes(facts, LEVELS)
    assert cells < facts.count() and {n for g, n in sizes.items() if g} == {cells}


def test_sketches_of_many_groups_need_no_sort(spark, tmp_dir, facts, monkeypatch):
    real, bounds = lattice.append_batch, []

    def spies(*args):
        bounds.append(int(spark.conf.get(lattice._FALLBACK, "128")))
        return real(*args)

    monkeypatch.setattr(lattice, "append_batch", spies)
    cube = CubeLattice(spark, f"{tmp_dir}/c", LEVELS, "amount", "buyer", IMPLIES)
    cube.plan(facts, 1)
    cube.add(facts, "1")
    assert bounds[0] == lattice.GROUPS_IN_MEMORY and set(bounds[1:]) == {128}
    spark.conf.set(lattice._FALLBACK, "7")                             # the session's own bound stays
    try:
        cube.add(facts, "2")
    finally:
        spark.conf.unset(lattice._FALLBACK)
    assert set(bounds[4:]) <= {7, 128} and 7 in bounds


def test_the_lattice_joins_its_facts_once(tables, monkeypatch):
    from olapkit.plans import warehouse

    seen, real = [], CubeLattice.plan
    monkeypatch.setattr(warehouse, "stored", lambda name, inputs, build: build())
    monkeypatch.setattr(CubeLattice, "plan", lambda self, facts, n: (seen.append(facts), real(self, facts, n))[1])
    cube = warehouse.stored_lattice(tables)
    assert "Join" not in plan_text(seen[0], mode="simple")
    assert cube.batches() == ["from-1998", "to-1997"]
