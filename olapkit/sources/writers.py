"""Sinks: CSV/parquet writes, typed appends by column name, table layouts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of batches, and of folders of writes that are not published.
BATCH_NAME, ASIDE = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*"), "_aside-"
SAVE_MODES = ("append", "overwrite", "ignore", "error")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def align_to_schema(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Select the declared columns by name and cast to the declared types.

    ``INSERT INTO t (cols) SELECT ...`` matches by name here; Spark's own
    ``insertInto`` matches by position, which silently swaps same-typed
    columns, so it is not used.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in table_schema.fields if f.name.lower() not in have and not f.nullable]
    if missing:
        raise ValueError(f"non-nullable columns missing from the query: {missing}")
    cols = []
    for f in table_schema.fields:
        src = have.get(f.name.lower())
        c = F.col(src).cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def insert_into(df: DataFrame, table_schema: T.StructType, path: str, mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    """Append (or overwrite) a query result into a declared parquet table."""
    if mode not in SAVE_MODES:
        raise ValueError(mode)
    w = align_to_schema(df, table_schema).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """The file context of a path and a function that makes its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration())
    return context, lambda p: context.makeQualified(hadoop.Path(p))


def _move_once(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target is there; which of the two happened is decided by the file system."""
    context, at = _hadoop(spark, target)
    if context.util().exists(at(target)):
        return False
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(at(source), at(target), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e) or context.util().exists(at(target)):
            return False
        raise
    return True


def append_batch(df: DataFrame, table_schema: T.StructType, path: str, batch: str) -> bool:
    """Append a query result to a declared parquet table as the batch of a name, once (O-K2, O-K3).

    The rows are written aside, in a folder that readers pass over, and published by one rename to ``_batch=<name>``.
    A batch that is there already is dropped, so a repeated load changes nothing; a killed write leaves no rows (see
    ``drop_unpublished``). Of two writers of one batch, one wins. The table is a plain partitioned folder, and a later
    batch rewrites nothing. The file system's rename must be atomic (local, HDFS and like ones); returns whether the
    batch was added."""
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch name has letters, digits and . - only: {batch!r}")
    spark, target = df.sparkSession, f"{path.rstrip('/')}/_batch={batch}"
    context, at = _hadoop(spark, path)
    if context.util().exists(at(target)):
        return False
    aside = f"{path.rstrip('/')}/{ASIDE}{uuid.uuid4().hex}"
    align_to_schema(df, table_schema).write.parquet(aside)
    if _move_once(spark, aside, target):
        return True
    context.delete(at(aside), True)
    return False


def read_batches(spark: SparkSession, table_schema: T.StructType, path: str, names: bool = False) -> DataFrame:
    """All published rows of a table of batches, with their batch's name as ``_batch`` if asked for. A filter on it
    prunes folders. A table without batches is empty."""
    full = T.StructType([*table_schema.fields, T.StructField("_batch", T.StringType())])
    context, at = _hadoop(spark, path)
    if not context.util().exists(at(path)):
        df = spark.createDataFrame([], full)
    else:
        df = spark.read.schema(full).option("basePath", path).parquet(f"{path.rstrip('/')}/_batch=*") \
            if context.util().globStatus(at(f"{path.rstrip('/')}/_batch=*")) else spark.createDataFrame([], full)
    return df if names else df.drop("_batch")


def drop_unpublished(spark: SparkSession, path: str, older_than_s: int = 24 * 3600) -> int:
    """Remove what killed writes left aside, if it is older than any write that may still run; returns the number."""
    context, at = _hadoop(spark, path)
    now, dropped = spark._jvm.java.lang.System.currentTimeMillis(), 0
    for status in context.util().globStatus(at(f"{path.rstrip('/')}/{ASIDE}*")) or []:
        if now - status.getModificationTime() >= older_than_s * 1000:
            dropped += context.delete(status.getPath(), True)
    return dropped


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_layout(df: DataFrame, table: str, layout: str = "plain", *, partition_by: Sequence[str] = (),
                 bucket_by: Sequence[str] = (), sort_by: Sequence[str] = (), buckets: int = 64,
                 path: str | None = None, mode: str = "overwrite") -> None:
    """Write a table in one of the warehouse layouts.

    * ``plain``: no distribution or sort key.
    * ``dist``: ``partition_by`` -> a directory per value, which filters
      prune; distribution key -> ``bucketBy`` (co-located joins without an
      exchange when both sides share the bucketing); sort key -> ``sortBy``
      inside buckets so parquet min/max statistics skip row groups. Rows are
      hash-partitioned into exactly ``buckets`` tasks first, so each bucket
      is one file (per directory). A bucket cannot be split at read time:
      salt hot values of the distribution key before.
      Replicated small tables need no layout: the planner broadcasts them
      after checking their size.
    Tables are saved through the catalog (bucketing needs it); ``path`` puts
    the data in a chosen (shared) folder.
    """
    if layout not in ("plain", "dist"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "dist":
        if bucket_by:
            # same hash as the bucketing: each task holds one bucket and writes one
            # file, instead of every task writing a file for every bucket
            df = df.repartition(buckets, *bucket_by)
        elif sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    w = df.write.mode(mode).format("parquet")
    if path is not None:
        w = w.option("path", path)
    if layout == "dist":
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            w = w.bucketBy(buckets, *bucket_by)
            if sort_by:
                w = w.sortBy(*sort_by)
    w.saveAsTable(table)


def load_tables(tables: dict, database: str, layout: str = "plain", layouts: dict | None = None,
                buckets: int = 64, location: str | None = None) -> list[tuple[str, float]]:
    """Bulk-load a set of tables into ``database`` and time each load (O-S6).

    ``layouts`` gives per-table ``bucket_by`` / ``sort_by`` for the ``dist``
    layout. Returns ``(table, seconds)`` pairs; the timings are driver wall
    clock around each write job.
    """
    import time

    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    out = []
    for name, df in tables.items():
        opts = (layouts or {}).get(name, {}) if layout == "dist" else {}
        t0 = time.perf_counter()
        write_layout(df, f"{database}.{name}", layout, buckets=buckets, **opts)
        out.append((name, round(time.perf_counter() - t0, 3)))
    return out
