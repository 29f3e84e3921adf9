"""Dimensions with validity dates that move (O-DM8, O-DM10): every load is compared with the open rows.

A history has the dimension's columns, ``start_date`` (from which a row holds), ``end_date`` (from which it no longer
holds; NULL for the open row of a key) and ``row_hash`` over the tracked columns. ``changes`` finds, in one join of the
open rows with the load, what a load does: it opens rows for new keys, closes the row and opens another where the hash
differs, and closes rows of keys that are gone. Unchanged keys give no row, so what is written follows what changed:
``load`` merges the changes into a ``KeyedTable`` by key and start, which rewrites the touched buckets only.

Loads come in the order of their dates. A second load of the same date replaces what the first one opened, instead of
leaving rows that hold for no time (a row that the first one closed stays closed, and its key opens anew); a repeated
load changes nothing. NULL keys are keys like others. A key that a load
holds twice takes the last row by the columns' order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import KeyedTable, Merge
from .modeling import upsert

START, END, HASH = "start_date", "end_date", "row_hash"


def _hash(columns: Sequence[str]) -> Column:
    """A hash that tells NULL from an empty text and one column from the next."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def changes(history: DataFrame | None, load: DataFrame, key: Sequence[str], load_date: dt.date,
            tracked: Sequence[str] | None = None, close_missing: bool = True) -> DataFrame:
    """Rows of the history that a load opens or closes. A closed row has the key and start of the open row that it
    replaces. ``tracked``: the columns whose change counts (default: all but the key)."""
    key, day = list(key), F.lit(load_date).cast("date")
    tracked = [c for c in load.columns if c not in key] if tracked is None else list(tracked)
    new = upsert(load, key, []).select(*load.columns).withColumn(HASH, _hash(tracked))
    fresh = [F.col(f"n.{c}").alias(c) for c in load.columns]
    opened = [*fresh, day.alias(START), F.lit(None).cast("date").alias(END), F.col(f"n.{HASH}").alias(HASH)]
    if history is None:
        return new.alias("n").select(*opened)
    old = history.where(F.col(END).isNull()).withColumn("_old", F.lit(True))
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    both = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), same, "full")
    gone = F.col("n._new").isNull()
    differs = F.col("o._old").isNull() | (F.col(f"o.{HASH}") != F.col(f"n.{HASH}"))
    # a row that was opened the same day is replaced under its own start, not closed
    ends = (F.col("o._old") & (F.col(f"o.{START}") < day)) & (gone if close_missing else F.lit(False))
    ends = F.coalesce(ends, F.lit(False)) | F.coalesce(
        F.col("o._old") & F.col("n._new") & differs & (F.col(f"o.{START}") < day), F.lit(False))
    void = F.coalesce(F.col("o._old") & gone & (F.col(f"o.{START}") >= day), F.lit(False)) & F.lit(close_missing)
    closed = [F.col(f"o.{c}").alias(c) for c in load.columns] + [
        F.col(f"o.{START}").alias(START), day.alias(END), F.col(f"o.{HASH}").alias(HASH)]
    starts = F.coalesce(F.col("n._new") & differs, F.lit(False))
    as_struct = lambda cols: F.struct(*cols)
    out = F.filter(F.array(F.when(ends | void, as_struct(closed)), F.when(starts, as_struct(opened))),
                   lambda r: r.isNotNull())
    return both.select(F.explode(out).alias("r")).select("r.*")


def load(table: KeyedTable, rows: DataFrame, key: Sequence[str], load_date: dt.date,
         tracked: Sequence[str] | None = None, close_missing: bool = True) -> Merge:
    """Apply a load of a dimension to its stored history (a ``KeyedTable`` by key and ``start_date``)."""
    if table.key != [*key, START]:
        raise ValueError(f"the history must be keyed by {[*key, START]}")
    history = table.read() if table.versions() else None
    if history is not None:
        last = history.agg(F.max(F.greatest(START, F.coalesce(END, START)))).first()[0]
        if last is not None and load_date < last:
            raise ValueError(f"loads come in order: {load_date} is before {last}")
    return table.merge(changes(history, rows, key, load_date, tracked, close_missing), [])


def valid(history: DataFrame) -> DataFrame:
    """Rows that hold for some time (a row opened and taken back the same day does not)."""
    return history.where(F.col(END).isNull() | (F.col(END) > F.col(START)))


def as_of(history: DataFrame, day: dt.date | Column) -> DataFrame:
    """The dimension as it was on a day: at most one row per key."""
    at = F.lit(day).cast("date") if not isinstance(day, Column) else day
    return history.where((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END)))).drop(START, END, HASH)


def join_as_of(facts: DataFrame, history: DataFrame, fact_key: str, key: str, day: str, how: str = "left") -> DataFrame:
    """Facts with the dimension's row that held on their own day: an equi-join on the key with the interval as a further
    condition, so a hot key can be split like in any join."""
    h = history.alias("_h")
    on = (F.col(f"_f.{fact_key}") == F.col(f"_h.{key}")) & (F.col(f"_f.{day}").cast("date") >= F.col(f"_h.{START}")) & (
        F.col(f"_h.{END}").isNull() | (F.col(f"_f.{day}").cast("date") < F.col(f"_h.{END}")))
    rest = [F.col(f"_h.{c}").alias(c) for c in history.columns if c not in (key, START, END, HASH)]
    return facts.alias("_f").join(h, on, how).select("_f.*", *rest)
