"""Event-log operators: running sums per user (phases, marker periods),
per-user totals, plays per hour (O-W1..O-W5, O-E*).

A running sum is the window ``sum(flag)`` per user from the last event back
to the current one. A plain window puts all of one user's events in one
task. ``running_sum`` counts events per user first; a user with more than a
shuffle partition's fair share is *hot*, and its timeline is cut at quantiles
of its times into stretches of about half such a share. Its result is the
window sum inside the stretch plus the sum of the user's later stretches.
There are fewer hot users than shuffle partitions and fewer than four
stretches per partition, so that table is small whatever the size of the log.
Rows of equal time fall in one stretch, so the RANGE frame (ties share a
value) is preserved; the ROWS frame uses a tie-break column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mapping of the music-service pages onto the driver's event types.
PLAY, HOME, DOWNGRADE = "view", "click", "purchase"


def flag(cond: Column) -> Column:
    """0/1 integer flag of a predicate (the reference's typed UDF, native)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


#: Below this number of events a user is never hot.
FEWEST_HOT = 100_000


def _hot_bounds(df: DataFrame, by: list[str], ts: str, fewest: int) -> DataFrame | None:
    """(by..., _bounds): the hot users and the microseconds at which their timelines are cut; None without any."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    share = max(fewest, df.count() / parts)
    hot = counts.where(F.col("_n") > share).collect()
    if not hot:
        return None
    keys = spark.createDataFrame([tuple(r[c] for c in by) for r in hot], df.select(*by).schema)
    pieces = max(int(2 * r["_n"] / share) + 1 for r in hot)
    times = F.unix_micros(F.col(ts).cast("timestamp"))
    same = [F.col(f"_e.{c}").eqNullSafe(F.col(f"_h.{c}")) for c in by]
    own = df.select(*by, times.alias("_t")).alias("_e").join(F.broadcast(keys.alias("_h")), same).select(
        *[F.col(f"_e.{c}").alias(c) for c in by], "_t")
    bounds = own.groupBy(*by).agg(F.percentile_approx(
        "_t", [k / pieces for k in range(1, pieces)], 10_000).alias("_bounds")).collect()
    return spark.createDataFrame([tuple(r) for r in bounds], df.select(*by).schema.add("_bounds", T.ArrayType(T.LongType())))


def running_sum(df: DataFrame, value: str, by: Sequence[str], ts: str, out: str, *,
                descending: bool = True, frame: str = "range", tie_break: Sequence[str] = (),
                fewest_hot: int = FEWEST_HOT) -> DataFrame:
    """Cumulative ``sum(value)`` per ``by`` in ``ts`` order, from the first
    row in that order up to the current row (see module doc)."""
    by = list(by)
    direct = lambda c: F.col(c).desc() if descending else F.col(c).asc()
    order = [direct(ts)]
    if frame == "rows":
        order += [direct(c) for c in tie_break]
    elif frame != "range":
        raise ValueError(frame)

    def over(keys):
        w = Window.partitionBy(*keys).orderBy(*order)
        return (w.rangeBetween if frame == "range" else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)

    bounds = _hot_bounds(df, by, ts, fewest_hot)
    if bounds is None:
        return df.withColumn(out, F.sum(value).over(over(by)).cast("bigint"))
    # fewer than 4 * shuffle partitions bounds in all: a proven size for the broadcasts
    times = F.unix_micros(F.col(ts).cast("timestamp"))
    same = [F.col(f"_e.{c}").eqNullSafe(F.col(f"_b.{c}")) for c in by]
    cut = df.alias("_e").join(F.broadcast(bounds.alias("_b")), same, "left").select("_e.*", F.size(F.filter(
        F.coalesce("_bounds", F.array().cast("array<bigint>")), lambda b: b < times)).alias("_stretch"))
    local = cut.withColumn("_local", F.sum(value).over(over([*by, "_stretch"])))
    totals = cut.groupBy(*by, "_stretch").agg(F.sum(value).alias("_tot"))
    hot = totals.alias("_e").join(F.broadcast(bounds.alias("_b")), same, "left_semi")
    earlier = Window.partitionBy(*by).orderBy(direct("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = hot.select(*by, "_stretch", F.sum("_tot").over(earlier).alias("_off"))
    match = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in [*by, "_stretch"]]
    return (local.alias("_l").join(F.broadcast(offsets.alias("_o")), match, "left")
            .select("_l.*", (F.col("_l._local") + F.coalesce("_o._off", F.lit(0))).cast("bigint").alias(out))
            .drop("_stretch", "_local"))


def flag_phase(df: DataFrame, user: str, ts: str, cond: Column, out: str = "phase",
               flag_col: str = "flagged", **kw) -> DataFrame:
    """Mark events where ``cond`` holds and give every event of a user the
    number of marked events at or after it (O-W4): phase 0 is after the
    user's last marked event, 1 the stretch before it, and so on."""
    df = df.withColumn(flag_col, flag(cond))
    return running_sum(df, flag_col, [user], ts, out, descending=True, **kw)


def sessionize_by_marker(df: DataFrame, user: str, ts: str, marker: Column, out: str = "period",
                         **kw) -> DataFrame:
    """Period id per event: the count of marker events at or after it,
    walking back in time (O-W5)."""
    df = df.withColumn("_marker", flag(marker))
    return running_sum(df, "_marker", [user], ts, out, descending=True, **kw).drop("_marker")


def avg_per_period(df: DataFrame, user: str, period: str, count_cond: Column, name: str) -> DataFrame:
    """Average number of ``count_cond`` events per (user, period) that has any."""
    counts = df.filter(count_cond).groupBy(user, period).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.avg("_n").alias(name))


def per_user_totals(df: DataFrame, user: str, home: Column, play: Column) -> DataFrame:
    """Home visits and plays per user (the whole-partition window of the
    reference is one grouped aggregate)."""
    return df.groupBy(user).agg(
        F.sum(flag(home)).cast("bigint").alias("home_count"),
        F.sum(flag(play)).cast("bigint").alias("nextsong_count"))
