"""Validity dates against a brute-force history."""

import datetime as dt
import random

import pytest

from olapkit.operators import history
from olapkit.operators.keyed import KeyedTable

from .conftest import rows_of

SCHEMA = "k long, a string, b int"


def brute(loads):
    """key -> list of [row, start, end]"""
    out = {}
    for day, rows in loads:
        now = {}
        for r in sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) if not isinstance(v, str)
                                                  else (True, v) for v in r[1:])):
            now[r[0]] = r
        for k, spans in out.items():
            if spans and spans[-1][2] is None and spans[-1][0] != now.get(k):
                if spans[-1][1] == day:
                    spans.pop()
                else:
                    spans[-1][2] = day
        for k, r in now.items():
            spans = out.setdefault(k, [])
            if not spans or spans[-1][2] is not None or spans[-1][0] != r:
                if not (spans and spans[-1][2] is None):
                    spans.append([r, day, None])
    return sorted(((*r, s, e) for spans in out.values() for r, s, e in spans), key=str)


def test_history_against_brute_force(spark, tmp_dir):
    rng = random.Random(9)
    table = KeyedTable(spark, f"{tmp_dir}/h", ["k", history.START], 3)
    loads, day = [], dt.date(2024, 1, 1)
    for n in range(5):
        rows = [(k, rng.choice(["x", "y", "", None]), rng.choice([1, None])) for k in [None, *range(8)] if rng.random() < 0.7]
        rows += rows[:1]                                  # a repeated row
        loads.append((day, rows))
        for _ in range(2 if n == 3 else 1):               # a repeated load
            history.load(table, spark.createDataFrame(rows, SCHEMA), ["k"], day)
        got = history.valid(table.read()).select("k", "a", "b", "start_date", "end_date")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(loads)
        day += dt.timedelta(days=rng.choice([1, 30]))
    for at in (loads[0][0], loads[2][0] + dt.timedelta(days=0), loads[-1][0]):
        want = sorted(((k, a, b) for k, a, b, s, e in brute(loads) if s <= at and (e is None or at < e)), key=str)
        assert sorted((tuple(r) for r in history.as_of(history.valid(table.read()), at).select("k", "a", "b").collect()), key=str) == want


def test_two_loads_of_a_day_and_order_of_loads(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/h", ["k", history.START], 2)
    make = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    one, two = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    history.load(table, make((1, "x", 1), (2, "x", 1)), ["k"], one)
    history.load(table, make((1, "y", 1), (3, "x", 1)), ["k"], two)
    history.load(table, make((1, "z", 1), (2, "x", 1)), ["k"], two)   # corrects the load of the same day
    got = rows_of(history.valid(table.read()).select("k", "a", "start_date", "end_date"))
    assert got == [(1, "x", one, two), (1, "z", two, None), (2, "x", one, two), (2, "x", two, None)]
    with pytest.raises(ValueError):
        history.load(table, make((1, "z", 1)), ["k"], one)
    with pytest.raises(ValueError):
        history.load(KeyedTable(spark, f"{tmp_dir}/x", ["k"], 2), make((1, "z", 1)), ["k"], one)


def test_tracked_columns_and_missing_keys(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    first = history.changes(None, make((1, "x", 1), (2, "x", 1)), ["k"], dt.date(2024, 1, 1), tracked=["a"])
    only_a = history.changes(first, make((1, "x", 7), (3, None, 1)), ["k"], dt.date(2024, 1, 2), tracked=["a"], close_missing=False)
    assert rows_of(only_a.select("k", "end_date")) == [(3, None)]
    first = history.changes(None, make((1, "x", 1), (2, "x", 1)), ["k"], dt.date(2024, 1, 1))
    # NULL is not the empty text, and columns do not run into one another
    assert history.changes(first, make((1, "", 1), (2, "x", 1)), ["k"], dt.date(2024, 1, 2)).count() == 2
    assert history.changes(first, make((1, None, 1), (2, "x", 1)), ["k"], dt.date(2024, 1, 2)).count() == 2
    assert history.changes(first, make((2, "x", 1), (1, "x", 1)), ["k"], dt.date(2024, 1, 2)).count() == 0


def test_join_as_of_takes_the_row_of_the_day(spark):
    h = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1), dt.date(2024, 2, 1), ""), (1, "y", dt.date(2024, 2, 1), None, "")],
                              "k long, a string, start_date date, end_date date, row_hash string")
    facts = spark.createDataFrame([(1, dt.datetime(2024, 1, 31, 23)), (1, dt.datetime(2024, 2, 1)), (1, dt.datetime(2023, 1, 1)),
                                   (None, dt.datetime(2024, 2, 1))], "f long, at timestamp")
    got = history.join_as_of(facts, h, "f", "k", "at")
    assert got.columns == ["f", "at", "a"] and sorted(str(r.a) for r in got.collect()) == ["None", "None", "x", "y"]
