"""Incremental upsert against the full one."""

import random

import pytest
from pyspark.sql import functions as F

from olapkit.operators import keyed
from olapkit.operators.keyed import KeyedTable
from olapkit.operators.modeling import merge_upsert, upsert

from .conftest import rows_of

COLS = "k long, s string, v int, w double"


def make(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_merges_equal_the_full_upsert(spark, tmp_dir):
    rng = random.Random(4)
    draw = lambda n, keys: make(spark, [(rng.choice([None, *range(keys)]), rng.choice(["a", "b", None]), rng.randint(0, 9),
                                         rng.choice([None, 0.5, 1.5])) for _ in range(n)])
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k", "s"], 5)
    first = draw(200, 40)
    assert t.merge(first, ["v"]).version == 1
    want = upsert(first, ["k", "s"], ["v"]).select(*first.columns)
    assert rows_of(t.read()) == rows_of(want)
    before = rows_of(t.read())
    for k in range(3):
        changes = draw(30, 60)
        want = make(spark, rows_of(merge_upsert(want, changes, ["k", "s"], ["v"])))
        done = t.merge(changes, ["v"])
        assert done.version == k + 2 and rows_of(t.read()) == rows_of(want)
    assert rows_of(t.read(1)) == before
    again = t.merge(changes, ["v"])                     # a repeated batch changes nothing
    assert rows_of(t.read()) == rows_of(want) and again.rows_read > 0
    assert t.merge(make(spark, [])).version == again.version
    assert rows_of(t.read()) == rows_of(want)


def test_bytes_follow_the_changes(spark, tmp_dir, monkeypatch):
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 32)
    rows = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("s"), F.lit(1).alias("v"),
                                            F.lit(0.5).alias("w"))
    assert t.merge(rows).rows_written == 10_000
    few = make(spark, [(2 * k, "y", 2, None) for k in range(3)])
    done = t.merge(few)
    assert done.buckets <= 3 and done.rewritten == done.buckets and done.rows_written < 3 * 10_000 / 32 * 2
    assert done.rows_read == done.rows_written
    # keys beyond every range, and odd keys between: hardly a filter says yes, so (nearly) nothing is read again
    new = t.merge(make(spark, [(100_000 + k, "n", 3, None) for k in range(50)]))
    assert new.rows_read == 0 and new.rewritten == 0 and new.rows_written == 50
    odd = t.merge(make(spark, [(2 * k + 1, "o", 4, None) for k in range(5)]))
    assert odd.rewritten <= 2 and odd.rows_written <= 5 + odd.rows_read
    assert t.read().count() == 10_055 and t.read().where("s = 'y'").count() == 3
    # many small appends: the next write makes one folder of them
    monkeypatch.setattr(keyed, "MOST_FOLDERS", 3)
    t.merge(make(spark, [(200_000 + k, "n", 3, None) for k in range(200)]))
    last = t.merge(make(spark, [(300_000 + k, "n", 3, None) for k in range(200)]))
    assert last.rewritten > 0 and t.read().count() == 10_455 and t.read().groupBy("k").count().where("count > 1").count() == 0


def test_a_second_publisher_and_bad_arguments(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], 2)
    with pytest.raises(ValueError):
        t.read()
    t.merge(make(spark, [(1, "a", 1, None)]))
    with pytest.raises(RuntimeError):
        t._publish(t._index(), 1)
    with pytest.raises(ValueError):
        t.read(7)
    with pytest.raises(ValueError):
        KeyedTable(spark, tmp_dir, [], 2)
    assert t.versions() == [1] and t.read().count() == 1
