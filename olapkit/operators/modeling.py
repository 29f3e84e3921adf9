"""Data-modelling jobs: normal forms, denormalisation, surrogate keys,
one dataset per query, upsert by key (O-DM1..O-DM6, O-DM13, O-DM14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_LOCAL_BITS = 33   # monotonically_increasing_id: partition id above bit 33, row index below


def to_1nf(df: DataFrame, array_col: str, out_col: str) -> DataFrame:
    """One row per element of a list column (O-DM1)."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, F.explode(array_col).alias(out_col))


def split_entity(df: DataFrame, key: Sequence[str], attrs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """2NF: attributes that depend on ``key`` only go to a parent table stored
    once per key; the rest stays as the child (O-DM2).

    ``distinct`` over key + attributes is a hash aggregation with no buffers;
    if an attribute does not in fact depend on the key, the parent shows more
    rows than keys instead of silently keeping an arbitrary one.
    """
    key, attrs = list(key), list(attrs)
    parent = df.select(*key, *attrs).distinct()
    child = df.drop(*attrs)
    return parent, child


def add_surrogate_key(df: DataFrame, order_cols: Sequence[str], id_col: str = "id",
                      num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in ``order_cols`` order (SERIAL).

    No window over all rows: rows are range-partitioned and sorted on the
    order columns (adaptive execution sizes the partitions from the rows
    themselves, so five values give one partition whatever they were derived
    from), and written with their partition and place to the shared folder,
    so every later read sees the same places. Each partition's offset is the
    running sum of the partition sizes: a table with one row per partition,
    which is what the window and the join see. ``order_cols`` should be
    unique per row (add a key as the last column) so ties cannot split
    unevenly.
    """
    order_cols = list(order_cols)
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    path = scratch_path(df.sparkSession, "ranked")
    (ranged.sortWithinPartitions(*order_cols)
     .withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
     .write.parquet(path))
    ranked = df.sparkSession.read.parquet(path)
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), _LOCAL_BITS)
    return (ranked.join(offsets, "_pid")
            .withColumn(id_col, (F.col("_off") + local + F.lit(start)).cast("bigint"))
            .drop("_pid", "_mono", "_off"))


def extract_dimension(df: DataFrame, attr: str, id_col: str, name_col: str | None = None,
                      first_seen_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """3NF: move a transitively dependent attribute to its own table with a
    new id and keep only the id in ``df`` (O-DM3).

    Ids follow the value order, or with ``first_seen_by`` the order in which
    values first appear along that column (``SERIAL`` assigned at insert
    time); the value breaks ties. NULL is a value like others: it gets an id,
    and its rows keep it.
    """
    name_col = name_col or attr
    if first_seen_by:
        values = (df.groupBy(F.col(attr).alias(name_col))
                  .agg(F.min(first_seen_by).alias("_first")))
        order = ["_first", name_col]
    else:
        values = df.select(F.col(attr).alias(name_col)).distinct()
        order = [name_col]
    dim = add_surrogate_key(values, order, id_col).select(id_col, name_col)
    # NULL is a value of its own with an id: null-safe, or its rows would vanish
    keyed = dim.select(F.col(name_col).alias("_value"), id_col)
    slim = df.join(keyed, F.col(attr).eqNullSafe(F.col("_value"))).drop(attr, "_value")
    return dim, slim


def denormalize(base: DataFrame, lookups: Sequence[tuple[DataFrame, str | list[str], str]]) -> DataFrame:
    """Fold lookup tables into a reporting table: ``(frame, on, how)`` each (O-DM5)."""
    out = base
    for frame, on, how in lookups:
        out = out.join(frame, on, how)
    return out


def upsert(df: DataFrame, key: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order_cols`` (last write wins, O-DM14).

    The row number in descending order (the remaining columns follow as
    tie-breaks, so full ties pick the same row every run) is cut at 1; Spark
    applies that cut to each input partition before the shuffle too, so a hot
    key sends one row per partition.
    """
    key = list(key)
    ordering = [*order_cols, *[c for c in df.columns if c not in key and c not in order_cols]]
    last = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in ordering]))
    return df.withColumn("_nth", last).where("_nth = 1").select(*key, *ordering)


def merge_upsert(base: DataFrame, changes: DataFrame, key: Sequence[str],
                 order_cols: Sequence[str] = ()) -> DataFrame:
    """Apply a batch of writes to a table keyed by ``key``: a key written in
    ``changes`` takes the changed row (a later write wins), other keys keep
    their row (O-DM14). Inside one batch, ``order_cols`` (then the remaining
    columns) pick the winner, as in ``upsert``."""
    both = (base.withColumn("_batch", F.lit(0))
            .unionByName(changes.select(*base.columns).withColumn("_batch", F.lit(1))))
    return upsert(both, key, ["_batch", *order_cols]).drop("_batch").select(*base.columns)


def materialize_for_query(df: DataFrame, path: str, partition_key: Sequence[str],
                          clustering: Sequence[str] = (), directories: bool = True,
                          num_partitions: int | None = None, mode: str = "overwrite") -> DataFrame:
    """One dataset per access path (O-DM13): partition key -> directory
    partitions (``directories=True``, for low-cardinality keys) or sorted
    file ranges (high-cardinality keys, never one directory per value);
    clustering columns -> sort order inside files, so parquet min/max
    statistics skip row groups. Range partitioning on key + clustering + a
    hash of the whole row splits a hot key over several tasks instead of one
    (the hash is deterministic, so a recomputed task sees the same rows);
    adaptive execution sizes the partitions from the rows."""
    keys = [*partition_key, *clustering]
    spark = df.sparkSession
    order = [*[F.col(k) for k in keys], F.xxhash64(*[F.col(c) for c in df.columns])]
    laid = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    laid = laid.sortWithinPartitions(*keys)
    w = laid.write.mode(mode)
    if directories:
        w = w.partitionBy(*partition_key)
    w.parquet(path)
    return spark.read.parquet(path)


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Compound-key lookup: equality on partition key and clustering columns (O-P12)."""
    cond: Column | None = None
    for c, v in equals.items():
        e = F.col(c) == v
        cond = e if cond is None else cond & e
    return df.filter(cond) if cond is not None else df
