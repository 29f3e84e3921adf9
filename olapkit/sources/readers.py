"""Sources: table scans, JSON/text/CSV readers, bulk loads, file listings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stored import file_indexes, input_bytes, snapshot


def read_table(spark: SparkSession, root: str | None, name: str) -> DataFrame:
    """Scan a relational table: ``{root}/{name}.parquet`` or a catalog table.

    The scan is lazy; Catalyst pushes projections and filters of the query
    that uses it into the parquet reader. The schema of a table read before is
    used again, without reading footers, while the snapshot of its files is
    the same.
    """
    if root is None:
        return spark.table(name)
    path = f"{root.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key in _SCHEMAS:
        state, schema = _SCHEMAS[key]
        df = spark.read.schema(schema).parquet(path)
        if snapshot([df]) == state:
            return df
    df = spark.read.parquet(path)
    _SCHEMAS[key] = (snapshot([df]), df.schema)
    return df


#: (application, path) -> (snapshot, schema) of tables that were read.
_SCHEMAS: dict[tuple[str, str], tuple[tuple, T.StructType]] = {}


class Tables:
    """Lazy accessor for a set of tables under one root: ``t.orders``."""

    def __init__(self, spark: SparkSession, root: str | None):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.root, name)

    def get(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)


def read_events_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     mode: str = "FAILFAST") -> DataFrame:
    """Newline-delimited JSON event log. An explicit schema avoids the
    inference pass over the whole input. A broken line fails the job unless
    another ``mode`` is asked for."""
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines (gz is decoded by the Hadoop codecs) as one ``value`` column."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             sep: str = ",", header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with header. Without a schema every column is a string. A row that
    does not fit fails the job unless another ``mode`` is asked for."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _schema(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def _line_blocks(lines: DataFrame, parts: int, block: int = 4096) -> DataFrame:
    """Lines dealt over ``parts`` partitions, ``block`` neighbours at a time: by place and not by content, so equal lines
    spread and nothing is sorted. A recomputed task reads the same lines in the same order."""
    placed = lines.withColumn("_block", F.expr(f"monotonically_increasing_id() div {block}"))
    return placed.repartition(parts, "_block").drop("_block")


def _few_gz(lines: DataFrame, wanted: int) -> bool:
    """Whether the files behind a text scan are gz, which cannot be split, and fewer than ``wanted``. The scan's own
    listing tells; at most ``wanted`` names are looked at."""
    (index,) = file_indexes(lines)
    files = index.inputFiles()
    return 0 < len(files) < wanted and all(f.lower().endswith(".gz") for f in files)


def bulk_load(spark: SparkSession, path_glob: str, schema: T.StructType | str, sep: str = ";",
              header: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Delimited (optionally gz) files with a declared schema. A row with
    missing or extra fields, or a value that is not of its type, fails the
    load; see ``bulk_load_checked`` to keep the good rows.

    Split part files load as one task each. A gz file cannot be split, so
    where there are fewer gz files than ``min_partitions`` (default: the
    cluster's parallelism), decompressing and parsing are set apart: one task
    a file reads raw lines and deals blocks of them to as many parsing tasks.
    There, a header is every line that equals the first one, as in Spark's
    reader of line datasets.
    """
    declared = _schema(schema)
    wanted = min_partitions or spark.sparkContext.defaultParallelism
    reader = spark.read.option("sep", sep).option("mode", "FAILFAST").schema(declared)
    lines = spark.read.text(path_glob)
    if _few_gz(lines, wanted):
        if header and (first := lines.first()) is not None:
            lines = lines.where(F.col("value") != first[0])
        return _from_lines(reader, _line_blocks(lines, wanted))
    df = reader.option("header", header).csv(path_glob)
    if min_partitions is not None and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def _from_lines(reader: DataFrameReader, lines: DataFrame) -> DataFrame:
    """Rows of a frame of lines by Spark's CSV reader: its parser, modes and errors are those of a file scan."""
    strings = getattr(lines._jdf, "as")(lines.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(strings), lines.sparkSession)


@dataclass
class Loaded:
    rows: DataFrame
    rejects: DataFrame


def bulk_load_checked(spark: SparkSession, path_glob: str, schema: T.StructType | str, sep: str = ";",
                      header: bool = False) -> Loaded:
    """As ``bulk_load``, but rows that do not fit go to ``rejects`` (column
    ``line``) instead of failing the load. No row is lost: every line is in
    one of the two frames. A line is a row: no line breaks inside quotes."""
    declared = _schema(schema)
    full = T.StructType([*declared.fields, T.StructField("_bad", T.StringType())])
    lines, wanted = spark.read.text(path_glob), spark.sparkContext.defaultParallelism
    few = _few_gz(lines, wanted)
    if header:
        lines = lines.where(F.col("value") != sep.join(f.name for f in declared.fields))
    if few:
        lines = _line_blocks(lines, wanted)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    fields = sum(1 for _ in declared.fields)
    parsed = lines.select("value", F.from_csv("value", full.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    # the parser takes a short row as NULLs; its number of separators tells
    short = F.size(F.split("value", re.escape(sep))) < fields
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull() | short
    names = [F.col(f"r.`{f.name}`") for f in declared.fields]
    return Loaded(parsed.where(~bad).select(*names), parsed.where(bad).select(F.col("value").alias("line")))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files under a prefix with size and modification time. The binary
    content column is pruned, so file bodies are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def rows(spark: SparkSession, schema: T.StructType | str, data: Iterable[Sequence]) -> DataFrame:
    """Rows from literals (INSERT ... VALUES); for fixtures and small lookups."""
    return spark.createDataFrame(list(data), schema)


def register(name: str, df: DataFrame) -> DataFrame:
    """Named temporary view over a frame, for SQL statements."""
    df.createOrReplaceTempView(name)
    return df


def describe_columns(df: DataFrame) -> DataFrame:
    """Column listing (information_schema.columns / printSchema) as a frame."""
    spark = df.sparkSession
    data = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(
        data, "ordinal_position int, column_name string, data_type string, is_nullable boolean")


def sized_count(*frames: DataFrame, target_bytes: int = 256 << 20) -> int:
    """A bucket count for writing ``frames``' data: one per ``target_bytes``
    of input, at least the cluster's default parallelism."""
    n = -(-input_bytes(*frames) // target_bytes)
    return max(frames[0].sparkSession.sparkContext.defaultParallelism, n)
