"""Incremental load, stored cube, UDF equality, table loads."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from olapkit.functions.dates import epoch_ms, hour_of_epoch_ms
from olapkit.operators.olap import CubeQuery, materialize_cube
from olapkit.operators.star import build_star
from olapkit.sources import load_tables
from olapkit.streaming import incremental_load

from .conftest import plan_text


def _json(path, recs):
    with open(path, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_incremental_load_exactly_once(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    schema = "userId string, page string, ts long"
    _json(f"{src}/a.json", [{"userId": "1", "page": "Home", "ts": 1}, {"userId": "2", "page": "NextSong", "ts": 2}])
    incremental_load(spark, src, schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == 2
    _json(f"{src}/b.json", [{"userId": "3", "page": "Home", "ts": 3}])
    incremental_load(spark, src, schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")   # rerun: only the new file
    incremental_load(spark, src, schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")   # nothing new
    assert sorted(r.userId for r in spark.read.parquet(f"{tmp_dir}/sink").collect()) == ["1", "2", "3"]


def test_materialized_cube_prunes_by_grouping(tables, tmp_dir):
    cube = CubeQuery(build_star(tables)).cube("month", "store_country", with_id=True)
    stored = materialize_cube(cube, f"{tmp_dir}/cube")
    by_month = stored.filter("grouping_id = 1")
    assert "PartitionFilters: [isnotnull(grouping_id" in plan_text(by_month)
    assert by_month.count() == 12 and stored.filter("grouping_id = 3").count() == 1


def test_python_udf_hour_equals_native(spark, tables):
    """The reference computes the hour with a Python UDF; the native form gives the same."""
    @F.pandas_udf("int")
    def py_hour(ms: pd.Series) -> pd.Series:
        return pd.to_datetime(ms, unit="ms", utc=True).dt.hour.astype("int32")

    ev = tables.events.withColumn("ms", epoch_ms("ts"))
    diff = ev.filter(py_hour("ms") != hour_of_epoch_ms(F.col("ms"))).count()
    assert diff == 0


def test_load_tables_times_each_table(spark, tables, tmp_dir):
    got = load_tables({"nation": tables.nation, "region": tables.region}, "loadtest", "dist",
                      {"nation": {"bucket_by": ["n_nationkey"]}}, buckets=2, location=f"{tmp_dir}/db")
    assert [n for n, _ in got] == ["nation", "region"]
    assert spark.table("loadtest.nation").count() == 25


def test_describe_all_columns_strings_too(tables):
    d = tables.nation.describe()
    assert d.columns == ["summary", "n_nationkey", "n_name", "n_regionkey"]
    got = {r["summary"]: r for r in d.collect()}
    assert got["count"]["n_name"] == "25"
    assert (got["min"]["n_name"], got["max"]["n_name"]) == ("NATION_0", "NATION_9")
    assert got["mean"]["n_name"] is None


def test_date_key_pattern_trap(spark):
    from olapkit.functions.dates import date_key, is_weekend

    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-02-06 10:00:00' AS ts, TIMESTAMP_NTZ'2024-02-10 00:00:00' AS sat")
    r = df.select(date_key("ts").alias("k"), F.date_format("ts", "yyyyMMdd").cast("int").alias("good"),
                  F.date_format("ts", "yyyyMMDD").alias("day_of_year"),
                  is_weekend("ts").alias("wd"), is_weekend("sat").alias("we")).first()
    assert r["k"] == r["good"] == 20240206
    assert r["day_of_year"] == "20240237"          # DD is the day of the year
    assert (r["wd"], r["we"]) == (False, True)


def test_stored_star_prunes_fact_partitions_from_date_filter(spark, tables, tmp_dir):
    from olapkit.operators.star import read_star, write_star

    write_star(build_star(tables), f"{tmp_dir}/star")
    stored = read_star(spark, f"{tmp_dir}/star")
    assert "year_key" in stored.fact.columns
    q = CubeQuery(stored).by("month", "rating").dice({"year": [1997]})
    plan = plan_text(q.frame())
    assert "dynamicpruningexpression" in plan
    lazy = CubeQuery(build_star(tables)).by("month", "rating").dice({"year": [1997]}).frame()
    got = sorted(tuple(r) for r in q.frame().collect())
    assert got == sorted(tuple(r) for r in lazy.collect())


def test_sql_functions_are_native(spark):
    from olapkit.functions.sqlfuncs import register_functions

    assert set(register_functions(spark)) == {"get_hour", "is_flag"}
    df = spark.sql("SELECT is_flag('Home', 'Home') AS a, is_flag('NextSong', 'Home') AS b, "
                   "get_hour(5 * 3600000 + 59) AS h")
    assert tuple(df.first()) == (1, 0, 5)
    plan = plan_text(df)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
