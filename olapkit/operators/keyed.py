"""Incremental upsert of a keyed table (O-DM14): a batch of changes rewrites only the files that hold its keys.

Rows lie in folders by bucket, a hash of the key. A small index table has, per bucket and folder, the number of rows, the
lowest and highest key, and a filter: one bit per hashed key, in blocks of 32,768 bits. A merge

1. keeps the last write per key of the changes (``upsert``),
2. asks the index which folders of their buckets may hold their keys: by key range, then by filter bits,
3. reads these alone, drops the changed keys, and writes the rest with the changes to a new folder; a bucket whose
   filters deny all its changes gets the new rows beside what it has,
4. publishes a new index by one rename. Readers of an older version are not disturbed, and a killed merge leaves none.

So the bytes written follow the changes and the buckets that they touch, not the table. A bucket with ``MOST_FOLDERS``
folders is rewritten into one when it is next written to.

The index has a row per bucket and folder (buckets are sized to hold up to some hundred MB), and the paths that are read
go through the driver, as in any scan. A wrong yes of a filter costs a rewrite and changes no result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.writers import ASIDE, _hadoop, _move_once
from .modeling import upsert

MOST_FOLDERS, BITS_PER_ROW, BLOCK = 8, 16, 32768
INDEX = ["bucket", "folder", "rows", "low", "high", "bits", "block", "marks"]


@dataclass(frozen=True)
class Merge:
    """What a merge did: buckets with changes, buckets of these that were rewritten, rows read again, rows written."""

    version: int
    buckets: int
    rewritten: int
    rows_read: int
    rows_written: int


class KeyedTable:
    """A table with one row per key under a shared folder (see the module's docstring)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int):
        if buckets < 1 or not key:
            raise ValueError("a keyed table has a key and at least one bucket")
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    # ---- columns
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _key(self) -> Column:
        return F.struct(*self.key)

    def _position(self) -> Column:
        """The key's place among the ``bits`` of a folder's filter."""
        return F.pmod(F.xxhash64(F.lit("filter"), *self.key), F.col("bits"))

    # ---- versions
    def versions(self) -> list[int]:
        context, at = _hadoop(self.spark, self.path)
        found = context.util().globStatus(at(f"{self.path}/versions/v=*")) or []
        return sorted(int(s.getPath().getName()[2:]) for s in found)

    def _index(self, version: int | None = None) -> DataFrame | None:
        have = self.versions()
        if not have:
            return None
        version = have[-1] if version is None else version
        if version not in have:
            raise ValueError(f"no version {version}")
        return self.spark.read.parquet(f"{self.path}/versions/v={version}")

    def _places(self, index: DataFrame) -> list[str]:
        rows = index.select("folder", "bucket").distinct().collect()
        return sorted(f"{self.path}/data/{r.folder}/_bucket={r.bucket}" for r in rows)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the table as of a version (default: the newest)."""
        index = self._index(version)
        if index is None:
            raise ValueError(f"{self.path} has no version")
        return self.spark.read.parquet(*self._places(index))

    # ---- writing
    def _write(self, rows: DataFrame, folder: str) -> DataFrame:
        """Write rows to a new folder by bucket; its part of the index."""
        place = f"{self.path}/data/{folder}"
        (rows.withColumn("_bucket", self._bucket()).repartition("_bucket").sortWithinPartitions("_bucket", *self.key)
         .write.partitionBy("_bucket").parquet(place))
        made = self.spark.read.parquet(place).withColumnRenamed("_bucket", "bucket")
        sizes = made.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min(self._key()).alias("low"),
                                           F.max(self._key()).alias("high"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") * BITS_PER_ROW / BLOCK)).cast("long")
        sizes = sizes.withColumn("bits", blocks * BLOCK)
        marks = (made.select("bucket", *self.key).join(sizes.select("bucket", "bits"), "bucket")
                 .withColumn("position", self._position())
                 .groupBy("bucket", F.expr(f"position div {BLOCK}").alias("block"))
                 .agg(F.bitmap_construct_agg(F.expr(f"position % {BLOCK}")).alias("marks")))
        return sizes.join(marks, "bucket").withColumn("folder", F.lit(folder)).select(*INDEX)

    def _publish(self, index: DataFrame, version: int) -> None:
        aside = f"{self.path}/versions/{ASIDE}{uuid.uuid4().hex}"
        index.write.parquet(aside)
        if not _move_once(self.spark, aside, f"{self.path}/versions/v={version}"):
            context, at = _hadoop(self.spark, self.path)
            context.delete(at(aside), True)
            raise RuntimeError(f"version {version} of {self.path} was published by another merge")

    def _may_hold(self, latest: DataFrame, index: DataFrame) -> DataFrame:
        """(bucket, folder) that may hold a changed key: by range, then by filter bit."""
        ranges = index.select("bucket", "folder", "low", "high", "bits").distinct()
        near = latest.select(F.col("_bucket").alias("bucket"), *self.key).join(ranges, "bucket").where(
            (self._key() >= F.col("low")) & (self._key() <= F.col("high")))
        asked = near.withColumn("position", self._position()).select(
            "bucket", "folder", F.expr(f"position div {BLOCK}").alias("block"),
            F.expr(f"cast(position % {BLOCK} as int)").alias("bit")).distinct()
        byte = "cast(conv(hex(substring(marks, bit div 8 + 1, 1)), 16, 10) as int)"
        return asked.join(index.select("bucket", "folder", "block", "marks"), ["bucket", "folder", "block"]).where(
            F.expr(f"getbit({byte}, bit % 8) = 1")).select("bucket", "folder").distinct()

    def merge(self, changes: DataFrame, order_cols: Sequence[str] = ()) -> Merge:
        """Apply a batch of writes: a key in ``changes`` takes its last changed row by ``order_cols`` (then the other
        columns, as in ``upsert``), other keys keep their row. The first merge makes the table. Full re-runs of a batch
        give the same rows."""
        spark, have = self.spark, self.versions()
        version = have[-1] if have else 0
        path = scratch_path(spark, "keyed-changes")
        upsert(changes, self.key, order_cols).withColumn("_bucket", self._bucket()).write.parquet(path)
        latest = spark.read.parquet(path)
        changed = latest.select(F.col("_bucket").alias("bucket")).distinct()
        n_buckets = changed.count()
        if not n_buckets and have:
            return Merge(version, 0, 0, 0, 0)
        rows, old_index, rows_read, rewritten = latest.drop("_bucket"), None, 0, 0
        if have:
            old_index = self._index()
            folders = old_index.select("bucket", "folder", "rows").distinct()
            crowded = folders.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MOST_FOLDERS)
            due = self._may_hold(latest, old_index).unionByName(
                folders.join(crowded.join(changed, "bucket"), "bucket").select("bucket", "folder")).distinct()
            touched = folders.join(due, ["bucket", "folder"]).collect()  # a part of the index
            if touched:
                places = sorted(f"{self.path}/data/{r.folder}/_bucket={r.bucket}" for r in touched)
                rows_read, rewritten = sum(r.rows for r in touched), len({r.bucket for r in touched})
                old = spark.read.parquet(*places).select(*rows.columns)
                same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.key]
                kept = old.alias("o").join(latest.select(*self.key).alias("n"), same, "left_anti")
                rows = kept.unionByName(rows)
                gone = spark.createDataFrame([(r.bucket, r.folder) for r in touched], "bucket int, folder string")
                old_index = old_index.join(gone, ["bucket", "folder"], "left_anti").select(*INDEX)
        folder = uuid.uuid4().hex
        written = self._write(rows, folder)
        self._publish(written if old_index is None else old_index.select(*INDEX).unionByName(written), version + 1)
        n_rows = self._index(version + 1).where(F.col("folder") == folder).select("bucket", "rows").distinct().agg(
            F.sum("rows")).first()[0]
        return Merge(version + 1, n_buckets, rewritten, rows_read, n_rows or 0)
