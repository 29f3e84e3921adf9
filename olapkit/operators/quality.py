"""Data-quality checks for constraints Spark does not enforce
(O-DQ2..O-DQ5): foreign keys, primary keys, NOT NULL / length, load diffs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class ForeignKey:
    name: str
    child: DataFrame
    fk: str
    parent: DataFrame
    pk: str


def _common_type(a: T.DataType, b: T.DataType) -> str | None:
    """The type in which the two keys of one relation are compared: none to cast for equal types; numbers meet as a
    decimal that holds both, a number and a text as text."""
    if a == b:
        return None
    digits = lambda t: (38, 0) if isinstance(t, T.IntegralType) else (t.precision, t.scale)
    exact = (T.IntegralType, T.DecimalType)
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return "bigint"
    if isinstance(a, exact) and isinstance(b, exact):
        scale = max(digits(a)[1], digits(b)[1])
        return f"decimal(38,{scale})"
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return "double"
    return "string"


def fk_orphans(relations: Sequence[ForeignKey]) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent, counted per
    relation (O-DQ2).

    Per relation the child's key column alone is anti-joined with the
    parent's: a parent whose size the planner has checked is broadcast, and
    the child is not shuffled; a large parent shuffles with the child's keys,
    where adaptive execution splits a hot key. Keys of different types are
    compared in the common type of their own relation. Every relation is
    reported, also with 0 orphans.
    """
    parts = []
    for r in relations:
        common = _common_type(r.child.schema[r.fk].dataType, r.parent.schema[r.pk].dataType)
        key = lambda name: F.col(name).cast(common) if common else F.col(name)  # noqa: E731,B023
        child = r.child.select(key(r.fk).alias("_k")).where(F.col("_k").isNotNull())
        missing = child.join(r.parent.select(key(r.pk).alias("_k")), "_k", "left_anti")
        parts.append(missing.select(F.lit(r.name).alias("relation")))
    counts = _union(parts).groupBy("relation").agg(F.count(F.lit(1)).alias("_n"))
    names = relations[0].child.sparkSession.createDataFrame([(r.name,) for r in relations], "relation string")
    return names.join(counts, "relation", "left").select("relation", F.coalesce("_n", F.lit(0)).alias("orphans"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pk_duplicates(df: DataFrame, key: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key values that occur more than once, with their counts."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def not_null_report(df: DataFrame) -> DataFrame:
    """Per column: NULL count and (strings) the maximum length, from one
    aggregation pass; the single result row is turned into one row per column."""
    aggs, specs = [], []
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.count(F.when(F.col(f.name).isNull(), 1)).alias(f"n{i}"))
        if isinstance(f.dataType, T.StringType):
            aggs.append(F.max(F.length(f.name)).alias(f"l{i}"))
            length = F.col(f"l{i}")
        else:
            length = F.lit(None).cast("int")
        specs.append(F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                              length.alias("max_length")))
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*specs)).alias("c")).select("c.*")


def load_counts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Row counts of two loads of the same table and their difference."""
    a = first.select(F.lit(1).alias("side"))
    b = second.select(F.lit(2).alias("side"))
    return (a.unionByName(b)
            .agg(F.count(F.when(F.col("side") == 1, 1)).alias("first_count"),
                 F.count(F.when(F.col("side") == 2, 1)).alias("second_count"))
            .withColumn("difference", F.col("first_count") - F.col("second_count")))


def multiset_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows that the two frames hold in different numbers, with
    ``_surplus``: how many more ``first`` has. One pass over each side: rows
    count +1 and -1, and one aggregation over all columns sums them."""
    both = first.withColumn("_surplus", F.lit(1)).unionByName(second.withColumn("_surplus", F.lit(-1)))
    return both.groupBy(*first.columns).agg(F.sum("_surplus").alias("_surplus")).where("_surplus <> 0")


def load_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows present in one load and not the other (multiset difference both
    ways), labelled with the load they are missing from."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_surplus")))
    return (multiset_diff(first, second).withColumn("_copy", copies)
            .withColumn("missing_from", F.when(F.col("_surplus") > 0, "second").otherwise("first"))
            .drop("_surplus", "_copy"))
