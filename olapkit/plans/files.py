"""Source and sink keys: tables written as files of one
format and read back by its reader, file and column listings, literals."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.readers import (Tables, bulk_load, bulk_load_checked, describe_columns, list_files, read_csv,
                               read_events_json, read_log_lines, register, rows)
from ..sources.stored import manifest, manifest_changes, stored
from ..sources.writers import load_tables, write_csv
from .registry import query


def _files(t: Tables, name: str, table: str, write) -> str:
    """The folder with files of a table, written once per state of the table."""
    def build() -> str:
        path = scratch_path(t.spark, name)
        write(t.get(table), path)
        return path

    return stored(name, [t.get(table)], build)


@query("scan_json", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json(t: Tables):
    """JSON lines with a declared schema (O-S1)."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    path = _files(t, "events-json", "events", lambda df, p: df.write.option("timestampNTZFormat", micros).json(p))
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return read_events_json(t.spark, path, t.events.select(*names).schema)


@query("scan_text", "SELECT event_type || ' ' || event_id AS value FROM events")
def scan_text(t: Tables):
    """Text lines, one column (O-S2)."""
    line = F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))
    return read_log_lines(t.spark, _files(t, "events-text", "events", lambda df, p: df.select(line).write.text(p)))


@query("scan_csv", "SELECT * FROM customer")
def scan_csv(t: Tables):
    """CSV with header, written and read with the declared types (O-K1, O-S3)."""
    return read_csv(t.spark, _files(t, "customer-csv", "customer", write_csv), t.customer.schema)


def _delimited(parts: int | None):
    def write(df, path):
        df = df.coalesce(parts) if parts else df
        df.write.option("sep", ";").option("compression", "gzip").csv(path)

    return write


@query("bulk_load_parts", "SELECT * FROM orders")
def bulk_load_parts(t: Tables):
    """Delimited gz part files, one task each (O-S4)."""
    return bulk_load(t.spark, _files(t, "orders-parts", "orders", _delimited(None)), t.orders.schema)


@query("bulk_load_single", "SELECT * FROM supplier")
def bulk_load_single(t: Tables):
    """One gz file, which cannot be split: one task decompresses, four parse (O-S5)."""
    path = _files(t, "supplier-gz", "supplier", _delimited(1))
    return bulk_load(t.spark, path, t.supplier.schema, min_partitions=4)


@query("bulk_load_rejects", """
SELECT count(*) FILTER (WHERE s_suppkey % 10 <> 0) AS n_rows, count(*) FILTER (WHERE s_suppkey % 10 = 0) AS n_rejects,
       min(if(s_suppkey % 10 = 0, 'x' || s_suppkey || ';' || s_nationkey, NULL)) AS first_reject FROM supplier""")
def bulk_load_rejects(t: Tables):
    """Rows that do not fit the declared types are kept apart and counted: every tenth key is no number."""
    def write(df, path):
        key = F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.lit("x"), "s_suppkey")).otherwise(F.col("s_suppkey").cast("string"))
        df.select(key, "s_nationkey").write.option("sep", ";").option("compression", "gzip").csv(path)

    kinds = t.supplier.select("s_suppkey", "s_nationkey").schema
    loaded = bulk_load_checked(t.spark, _files(t, "supplier-dirty", "supplier", write), kinds)
    both = loaded.rows.select(F.lit(None).cast("string").alias("line")).unionByName(loaded.rejects)
    return both.agg(F.count_if(F.col("line").isNull()).alias("n_rows"), F.count("line").alias("n_rejects"),
                    F.min("line").alias("first_reject"))


def _order_lines(df, path):
    """Uncompressed lines of orders in folders by year and a part of the key, one file each."""
    line = F.concat_ws(";", "o_orderkey", "o_orderstatus")
    (df.select(F.year("o_orderdate").alias("year"), F.expr("o_orderkey % 4").alias("part"), line.alias("line"))
     .repartition("year", "part").write.mode("overwrite").partitionBy("year", "part").text(path))


@query("list_source_files", """
SELECT 'year=' || year(o_orderdate) || '/part=' || o_orderkey % 4 AS folder, 1 AS files,
       CAST(sum(strlen(o_orderkey || ';' || o_orderstatus) + 1) AS BIGINT) AS bytes FROM orders GROUP BY ALL""")
def list_source_files(t: Tables):
    """Files under a prefix: folder, number and total length as written, bodies unread (O-S8)."""
    found = list_files(t.spark, _files(t, "order-lines", "orders", _order_lines), "*.txt")
    folder = F.regexp_extract("path", r"(year=\d+/part=\d+)/[^/]+$", 1).alias("folder")
    return found.groupBy(folder).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query("manifest_changes", """
SELECT year(o_orderdate)::INTEGER AS year, if(year(o_orderdate) = 1997, 'added,removed', 'added') AS change, count(*) AS lines
FROM orders WHERE year(o_orderdate) >= 1997 GROUP BY ALL""")
def manifest_changes_q(t: Tables):
    """Files that changed between two manifests, per folder, and only the new ones are read (O-S8, O-S10): orders up to
    1997 are written by year; then 1997 is written again, and the later years are added."""
    def build():
        path, kept = scratch_path(t.spark, "orders-by-year"), scratch_path(t.spark, "orders-manifest")
        lines = t.orders.select(F.year("o_orderdate").alias("year"), F.concat_ws(";", "o_orderkey", "o_custkey").alias("line"))

        def write(df):
            for (y,) in sorted(df.select("year").distinct().collect()):
                df.where(F.col("year") == y).select("line").write.mode("overwrite").text(f"{path}/year={y}")

        write(lines.where("year <= 1997"))
        manifest(t.spark, path).write.parquet(kept)
        write(lines.where("year >= 1997"))
        return path, kept

    path, kept = stored("orders-by-year", [t.orders], build)
    changed = manifest_changes(t.spark.read.parquet(kept), manifest(t.spark, path))
    year = F.regexp_extract("path", r"year=(\d+)/", 1).cast("int")
    kinds = F.array_join(F.array_sort(F.collect_set("change")), ",").alias("change")
    per_year = changed.groupBy(year.alias("year")).agg(kinds)
    fresh = [r.path for r in changed.where("change <> 'removed'").select("path").collect()]
    lines = read_log_lines(t.spark, fresh).select(F.col("_metadata.file_path").alias("path"))
    return lines.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("lines")).join(per_year, "year").select(
        "year", "change", "lines")


LOADED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query("table_set_load", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in LOADED))
def table_set_load(t: Tables):
    """A set of tables bulk-loaded into a database of its own, and the rows of every loaded table (O-S6)."""
    def build() -> str:
        db = f"olapkit_load_{uuid.uuid4().hex[:10]}"
        load_tables({n: t.get(n) for n in LOADED}, db, location=scratch_path(t.spark, db))
        return db

    db = stored("table-set", [t.get(n) for n in LOADED], build)
    parts = [t.spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count") for n in LOADED]
    return functools.reduce(DataFrame.unionByName, parts)


@query("columns_of", """
SELECT ordinal_position, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'DATE' THEN 'date' END AS data_type, is_nullable = 'YES' AS is_nullable
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def columns_of(t: Tables):
    """Column listing of a table (O-DQ6)."""
    return describe_columns(t.lineitem)


@query("literal_view", """
SELECT label, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open')) l(status, label)
  ON o_orderstatus = status GROUP BY label""")
def literal_view(t: Tables):
    """Literal rows registered as a view and joined in SQL (O-S7, O-S9)."""
    register("olapkit_status_labels", rows(t.spark, "status string, label string", [("F", "finished"), ("O", "open")]))
    register("olapkit_orders", t.orders)
    return t.spark.sql("SELECT label, count(*) AS n FROM olapkit_orders JOIN olapkit_status_labels "
                       "ON o_orderstatus = status GROUP BY label")


@query("lazy_layout_totals", """
SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1""")
def lazy_layout_totals(t: Tables):
    """A grouped aggregate over a bulk-loaded folder (O-S4 feeding O-A6)."""
    return bulk_load_parts(t).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
