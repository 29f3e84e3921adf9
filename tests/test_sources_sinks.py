"""Readers and writers (O-S*, O-K*) on temporary folders."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapkit.sources import (Tables, align_to_schema, append_batch, bulk_load, bulk_load_checked, describe_columns,
                             drop_unpublished, insert_into, list_files, manifest, manifest_changes, manifest_digest,
                             read_batches, read_csv, read_events_json, read_log_lines, rows, snapshot, write_csv,
                             write_layout)
from olapkit.sources.writers import _move_once

from .conftest import plan_text, rows_of

EVENT_SCHEMA = T.StructType([
    T.StructField("artist", T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("ts", T.LongType()), T.StructField("userId", T.StringType()),
])


def test_json_lines_with_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log.json")
    with open(path, "w") as f:
        for r in [{"artist": "A", "page": "NextSong", "ts": 1, "userId": "1"},
                  {"artist": None, "page": "Home", "ts": 2, "userId": ""}]:
            f.write(json.dumps(r) + "\n")
    df = read_events_json(spark, path, EVENT_SCHEMA)
    assert df.schema == EVENT_SCHEMA
    assert rows_of(df.select("userID", "page")) == [("", "Home"), ("1", "NextSong")]  # case-insensitive names


def test_csv_roundtrip_is_all_strings_without_schema(spark, tmp_dir):
    df = rows(spark, "a int, b double", [(1, 2.5), (2, 3.5)])
    write_csv(df, f"{tmp_dir}/out")
    back = read_csv(spark, f"{tmp_dir}/out")
    assert [f.dataType for f in back.schema.fields] == [T.StringType(), T.StringType()]
    typed = read_csv(spark, f"{tmp_dir}/out", schema="a int, b double")
    assert rows_of(typed) == [(1, 2.5), (2, 3.5)]


def _write_gz(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


TICKET_SCHEMA = ("id double, sporting_event_id double, sport_location_id double, seat_level decimal(1,0), "
                 "seat_section string, seat_row string, seat string, ticketholder_id double, "
                 "ticket_price decimal(8,2)")


def test_bulk_load_parts_and_single_gz(spark, tmp_dir):
    lines = [f"{i};1;2;1;A;{i % 5};{i % 9};;{i}.50" for i in range(100)]
    os.makedirs(f"{tmp_dir}/parts")
    for p in range(4):
        _write_gz(f"{tmp_dir}/parts/part{p}.csv.gz", lines[p * 25:(p + 1) * 25])
    _write_gz(f"{tmp_dir}/one.csv.gz", lines)
    parts = bulk_load(spark, f"{tmp_dir}/parts/*.csv.gz", TICKET_SCHEMA)
    assert parts.rdd.getNumPartitions() == 4         # one task per gz part
    one = bulk_load(spark, f"{tmp_dir}/one.csv.gz", TICKET_SCHEMA, min_partitions=4)
    assert one.rdd.getNumPartitions() == 4           # unsplittable gz, spread afterwards
    assert parts.count() == one.count() == 100
    assert parts.exceptAll(one).count() == 0
    assert parts.filter(F.col("ticketholder_id").isNull()).count() == 100
    files = list_files(spark, f"{tmp_dir}/parts", "*.gz")
    assert files.count() == 4 and files.columns == ["path", "length", "modificationTime"]
    assert "content" not in plan_text(files).split("ReadSchema")[-1].split("\n")[0]


def test_log_lines(spark, tmp_dir):
    _write_gz(f"{tmp_dir}/a.log.gz", ["line one", "line two"])
    assert read_log_lines(spark, f"{tmp_dir}/a.log.gz").count() == 2


DECLARED = T.StructType([T.StructField("revenue", T.DecimalType(18, 2)), T.StructField("day", T.DateType()),
                         T.StructField("note", T.StringType())])


def test_insert_aligns_by_name_and_casts(spark, tmp_dir):
    q = spark.sql("SELECT DATE'2024-01-02' AS day, 12.345 AS revenue")
    aligned = align_to_schema(q, DECLARED)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in DECLARED]
    insert_into(q, DECLARED, f"{tmp_dir}/t")
    insert_into(q, DECLARED, f"{tmp_dir}/t")              # append
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.count() == 2 and str(back.first()["revenue"]) == "12.35"
    with pytest.raises(ValueError):
        insert_into(q, T.StructType([T.StructField("x", T.IntegerType(), False)]), f"{tmp_dir}/u")


def test_save_modes(spark, tmp_dir):
    df = rows(spark, "a int", [(1,)])
    df.write.mode("ignore").parquet(f"{tmp_dir}/m")
    rows(spark, "a int", [(2,)]).write.mode("ignore").parquet(f"{tmp_dir}/m")   # CREATE IF NOT EXISTS
    assert rows_of(spark.read.parquet(f"{tmp_dir}/m")) == [(1,)]
    rows(spark, "a int", [(3,)]).write.mode("overwrite").parquet(f"{tmp_dir}/m")  # DROP + CREATE
    assert rows_of(spark.read.parquet(f"{tmp_dir}/m")) == [(3,)]


def test_layouts_and_colocated_join(spark, tmp_dir):
    a = spark.range(0, 2000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    b = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lay LOCATION '{tmp_dir}/lay'")
    write_layout(a, "lay.fact", "dist", bucket_by=["k"], sort_by=["v"], buckets=4)
    write_layout(b, "lay.dim", "dist", bucket_by=["k"], buckets=4)
    write_layout(a, "lay.plain", "plain")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("lay.fact").join(spark.table("lay.dim"), "k").groupBy("k").agg(F.sum("w"))
        plan = plan_text(j)
        assert "Exchange hashpartitioning(k" not in plan.split("HashAggregate")[-1]
        assert "SortMergeJoin" in plan
        assert j.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_describe_columns(spark):
    df = rows(spark, "a int, b string", [(1, "x")])
    assert rows_of(describe_columns(df), ["column_name", "data_type"]) == [("a", "int"), ("b", "string")]


def test_tables_from_catalog(spark):
    from olapkit import plans
    from olapkit.sources.readers import Tables

    from .conftest import SF_SMALL

    by_path = Tables(spark, SF_SMALL)
    for name in ("orders", "customer", "nation"):
        by_path.get(name).createOrReplaceTempView(name)
    catalog = Tables(spark, None)
    assert catalog.orders.count() == by_path.orders.count()
    # a registered job runs on catalog tables too
    q = plans.queries()["point_lookup"]
    assert rows_of(q(spark, None)) == rows_of(q(spark, SF_SMALL))


def test_sized_count_follows_input_bytes(spark, tables):
    import os

    from olapkit.sources.readers import input_bytes, sized_count

    li = tables.lineitem
    on_disk = sum(os.path.getsize(f.replace("file://", "").replace("file:", "")) for f in li.inputFiles())
    assert input_bytes(li) == on_disk
    par = spark.sparkContext.defaultParallelism
    assert sized_count(li) == par                                   # small input: the parallelism floor
    assert sized_count(li, target_bytes=1024) == min(100_000, max(par, -(-on_disk // 1024)))
    assert sized_count(spark.range(10)) == par                      # no files: floor


def test_single_gz_is_parsed_apart(spark, tmp_dir):
    lines = [f"{i};{i % 7}.25;n{i}" for i in range(30_000)]
    _write_gz(f"{tmp_dir}/one.csv.gz", lines)
    schema = "id long, v double, s string"
    df = bulk_load(spark, f"{tmp_dir}/one.csv.gz", schema)
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 30_000
    plain = spark.read.schema(schema).option("sep", ";").csv(f"{tmp_dir}/one.csv.gz")
    assert df.schema == plain.schema and df.exceptAll(plain).count() == plain.exceptAll(df).count() == 0
    _write_gz(f"{tmp_dir}/head.csv.gz", ["id;v;s", '1;2.5;"a;b"', "", "2;;"])
    assert rows_of(bulk_load(spark, f"{tmp_dir}/head.csv.gz", schema, header=True)) == [(1, 2.5, "a;b"), (2, None, None)]
    for bad in ("x;1;a", "3;1", "3;1;a;b"):
        _write_gz(f"{tmp_dir}/bad.csv.gz", [*lines[:50], bad])
        with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
            bulk_load(spark, f"{tmp_dir}/bad.csv.gz", schema).collect()
        checked = bulk_load_checked(spark, f"{tmp_dir}/bad.csv.gz", schema)
        assert checked.rows.count() == 50 and rows_of(checked.rejects) == [(bad,)]


def test_rewrite_in_place_is_noticed(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    rows(spark, "a int, k int", [(1, 0), (2, 1)]).coalesce(1).write.partitionBy("k").parquet(root)
    before, files = snapshot([spark.read.parquet(root)]), manifest(spark, root).collect()
    assert snapshot([spark.read.parquet(root)]) == before
    kept = spark.createDataFrame(files, manifest(spark, root).schema)
    digest = manifest_digest(kept)
    target = next(r.path for r in files if "/k=1/" in r.path).replace("file://", "").replace("file:", "")
    length, folder = os.path.getsize(target), os.stat(root)
    os.utime(target, (0, 1_000_000))                       # same bytes and length, another time, in a nested folder
    assert os.path.getsize(target) == length and os.stat(root).st_mtime == folder.st_mtime
    assert snapshot([spark.read.parquet(root)]) != before
    assert manifest_digest(manifest(spark, root)) != digest == manifest_digest(kept)
    rows(spark, "a int, k int", [(3, 2)]).write.mode("append").partitionBy("k").parquet(root)
    os.remove(next(r.path for r in files if "/k=0/" in r.path).replace("file://", "").replace("file:", ""))
    found = {(c.path.split("/")[-2], c.change) for c in manifest_changes(kept, manifest(spark, root)).collect()}
    assert found == {("k=0", "removed"), ("k=1", "rewritten"), ("k=2", "added")}


def test_batches_are_published_once(spark, tmp_dir):
    path, one = f"{tmp_dir}/ledger", rows(spark, "day date, revenue double, note string", [(None, 1.5, "a"), (None, 2.5, None)])
    assert read_batches(spark, DECLARED, path).count() == 0
    assert append_batch(one, DECLARED, path, "2024-01-02") and not append_batch(one, DECLARED, path, "2024-01-02")
    assert append_batch(one.limit(1), DECLARED, path, "2024-01-03")
    got = read_batches(spark, DECLARED, path, names=True)
    assert got.columns == ["revenue", "day", "note", "_batch"] and got.count() == 3
    assert got.where("_batch = '2024-01-03'").count() == 1
    assert "PartitionFilters: [isnotnull(_batch" in plan_text(got.where("_batch = '2024-01-03'"))
    # a killed write leaves files aside, which nobody reads
    one.write.parquet(f"{path}/_aside-dead")
    assert read_batches(spark, DECLARED, path).count() == 3
    assert drop_unpublished(spark, path) == 0 and drop_unpublished(spark, path, 0) == 1
    # two writers of one batch: the second finds it there when it publishes
    one.write.parquet(f"{path}/_aside-late")
    assert not _move_once(spark, f"{path}/_aside-late", f"{path}/_batch=2024-01-02")
    assert read_batches(spark, DECLARED, path).count() == 3
    with pytest.raises(ValueError):
        append_batch(one, DECLARED, path, "../x")


def test_schema_of_a_rewritten_table_is_read_anew(spark, tmp_dir):
    rows(spark, "a int", [(1,)]).write.parquet(f"{tmp_dir}/x.parquet")
    assert Tables(spark, tmp_dir).x.columns == ["a"] and Tables(spark, tmp_dir).x.columns == ["a"]
    rows(spark, "b string", [("q",)]).write.mode("overwrite").parquet(f"{tmp_dir}/x.parquet")
    assert Tables(spark, tmp_dir).x.columns == ["b"] and rows_of(Tables(spark, tmp_dir).x) == [("q",)]
