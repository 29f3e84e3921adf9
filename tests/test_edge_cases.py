"""Cases that once gave wrong answers or stopped a job."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from olapkit import plans, session
from olapkit.functions.logs import log_timestamp
from olapkit.operators import events, modeling, ssb
from olapkit.operators.quality import ForeignKey, fk_orphans, load_diff
from olapkit.operators.weblog import bad_times, parse_access_log
from olapkit.sources import bulk_load, bulk_load_checked, input_bytes
from olapkit.sources.readers import Tables
from olapkit.sources.stored import root_paths

from .conftest import SF_ORACLE, SF_SMALL, plan_text, rows_of

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _revenue(spark, root):
    return plans.queries()["total_revenue"](spark, root).first()[0]


def test_new_files_give_new_answers(spark, tmp_dir):
    root = f"{tmp_dir}/db with space"
    for name in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    before = _revenue(spark, root)
    assert before == _revenue(spark, SF_SMALL)
    assert _revenue(spark, root) == before
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    lines.unionByName(lines).write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    assert _revenue(spark, root) == 2 * before


def test_repointed_catalog_tables_give_new_answers(spark):
    answers = []
    for root in (SF_SMALL, SF_ORACLE, SF_SMALL):
        for name in TABLES:
            spark.read.parquet(f"{root}/{name}.parquet").createOrReplaceTempView(name)
        answers.append(_revenue(spark, None))
    for name in TABLES:
        spark.catalog.dropTempView(name)
    assert answers[0] == answers[2] == _revenue(spark, SF_SMALL) and answers[1] == _revenue(spark, SF_ORACLE)


def test_tables_are_stored_once(spark):
    t = Tables(spark, SF_SMALL)
    from olapkit.plans.warehouse import stored_star

    assert root_paths(stored_star(t).fact) == root_paths(stored_star(t).fact)


def test_input_size_of_paths_with_blanks(spark, tmp_dir):
    path = f"{tmp_dir}/a b"
    spark.range(100).withColumn("k", F.lit("v 0")).write.partitionBy("k").parquet(path)
    assert input_bytes(spark.read.parquet(path)) > 0
    assert input_bytes(spark.range(5)) == 0


def _write(path, *lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_bulk_load_is_strict(spark, tmp_dir):
    path = f"{tmp_dir}/in.csv"
    _write(path, "1;2.5", "x;3.5", "3", "4;5.5;6", "7;8.5")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse|cast"):
        bulk_load(spark, path, "a int, b double").collect()
    loaded = bulk_load_checked(spark, path, "a int, b double")
    assert rows_of(loaded.rows) == [(1, 2.5), (7, 8.5)]
    assert rows_of(loaded.rejects) == [("3",), ("4;5.5;6",), ("x;3.5",)]
    _write(path, "a;b", "1;2.5")
    assert rows_of(bulk_load_checked(spark, path, "a int, b double", header=True).rows) == [(1, 2.5)]


def test_foreign_keys_compare_in_the_type_of_their_pair(spark):
    child = spark.createDataFrame([(1, "1"), (2, "9"), (None, None)], "i int, s string")
    exact = spark.createDataFrame([(1,)], "k int").select(F.col("k").cast("decimal(10,2)").alias("k"))
    text = spark.createDataFrame([("1",), ("2",)], "k string")
    got = fk_orphans([ForeignKey("dec", child, "i", exact, "k"), ForeignKey("txt", child, "s", text, "k"),
                      ForeignKey("mix", child, "i", text, "k")])
    assert rows_of(got) == [("dec", 1), ("mix", 0), ("txt", 1)]


def test_load_diff_counts_repeated_rows(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y"), (3, "y")], "k int, v string")
    assert rows_of(load_diff(a, b)) == [(1, None, "second"), (2, "x", "second"), (3, "y", "first"), (3, "y", "first")]


LINE = 'h - - [{}] "GET {} HTTP/1.0" 200 {}'
GOOD = "01/Jul/1995:00:00:01 -0400"


def test_log_fields_of_odd_lines(spark):
    lines = [LINE.format(GOOD, "/a\u0001b", "10"), LINE.format(GOOD, "/c", "10\rx"), LINE.format(GOOD, "/d", "7 z"),
             LINE.format("99/Foo/2024:00:00:01 -0400", "/e", "1"), "nothing", None]
    log = parse_access_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    got = {r.endpoint: r for r in log.parsed.collect()}
    assert set(got) == {"/a\u0001b", "/c", "/d", "/e"}
    assert all(r.response_code == "200" and r.protocol == "HTTP/1.0" for r in got.values())
    assert [got[e].content_size for e in ("/a\u0001b", "/c", "/d")] == ["10", "10", "7"]
    times = {r.endpoint: r.t for r in log.parsed.select("endpoint", log_timestamp(F.col("date_time")).alias("t")).collect()}
    assert times["/c"] == dt.datetime(1995, 7, 1, 4, 0, 1) and times["/e"] is None
    assert [r.endpoint for r in bad_times(log.parsed).collect()] == ["/e"]
    assert log.rejected.count() == 2


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_configure_keeps_what_is_set(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        session.configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_surrogate_keys_are_sized_by_their_own_rows(spark):
    values = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderpriority").distinct()
    got = modeling.add_surrogate_key(values, ["o_orderpriority"])
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4, 5]
    assert len([f for df in [got] for f in df.inputFiles()]) <= 5


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_running_sum_splits_hot_users(spark, frame):
    """User 1 and the missing user are hot, most of user 1's events fall in one minute, many at equal times."""
    e = spark.range(4000).select(
        F.when(F.col("id") % 10 < 6, 1).when(F.col("id") % 10 == 6, None).otherwise(F.col("id") % 50).alias("u"),
        F.timestamp_seconds(F.when(F.col("id") % 3 > 0, F.col("id") % 37).otherwise(F.col("id") * 60))
        .cast("timestamp_ntz").alias("ts"), "id", (F.col("id") % 5).alias("v"))
    order = [F.desc("ts")] + ([F.desc("id")] if frame == "rows" else [])
    w = Window.partitionBy("u").orderBy(*order)
    w = (w.rangeBetween if frame == "range" else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    want = rows_of(e.withColumn("s", F.sum("v").over(w)))
    got = events.running_sum(e, "v", ["u"], "ts", "s", frame=frame, tie_break=["id"], fewest_hot=50)
    assert rows_of(got) == want
    bounds = events._hot_bounds(e, ["u"], "ts", 50).collect()
    assert {r.u for r in bounds} >= {1} and max(len(set(r._bounds)) for r in bounds) >= 4


def test_ssb_fact_is_pruned_by_the_date_dimension(spark):
    for name in ("ssb_one_dim", "ssb_drill"):
        plan = plan_text(plans.queries()[name](spark, SF_SMALL), mode="simple")
        fact = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineorder" in line]
        assert fact and all("lo_year" in line.split("PartitionFilters: [")[1].split("]")[0] for line in fact), plan


def test_hot_parts_are_salted(spark):
    t = Tables(spark, SF_SMALL)
    src = ssb.ssb_tables(t)
    hot = src.lineorder.withColumn("lo_partkey", F.when(F.col("lo_orderkey") % 3 == 0, 1).otherwise(F.col("lo_partkey")))
    plain = ssb.SsbTables(hot, src.dwdate, src.part, src.supplier, src.customer)
    salted = ssb.spread_hot_parts(plain, buckets=8)
    (hot,) = ssb.hot_parts(plain, buckets=8).collect()   # a third of all lines and more: so many half buckets
    n, mine = plain.lineorder.count(), plain.lineorder.where("lo_partkey = 1").count()
    assert hot.hot == 1 and hot.salts == -(-mine * 16 // n)
    assert salted.lineorder.where("lo_partkey = 1").select("lo_salt").distinct().count() == hot.salts
    assert salted.part.where("p_partkey = 1").count() == hot.salts and salted.lineorder.count() == n
    for name in ssb.SSB_QUERIES:
        assert rows_of(ssb.run_ssb(spark, plain, name)) == rows_of(ssb.run_ssb(spark, salted, name))


def test_3nf_keeps_rows_with_null_attributes(spark):
    from olapkit.operators.modeling import extract_dimension

    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "id int, city string")
    for by in (None, "id"):
        dim, slim = extract_dimension(df, "city", "city_id", first_seen_by=by)
        assert slim.columns == ["id", "city_id"] and slim.count() == 4
        assert rows_of(slim.join(dim, "city_id").select("id", "city")) == [(1, "a"), (2, None), (3, None), (4, "b")]


def test_buckets_of_the_dist_layout_grow_with_the_lines(spark, monkeypatch):
    from olapkit.plans import ssb as ssb_plans
    from olapkit.sources import readers

    t = Tables(spark, SF_SMALL)
    for size, least, most in ((0, 1, 64), (3 << 30, 60, 100), (1 << 50, 100_000, 100_000)):
        monkeypatch.setattr(readers, "input_bytes", lambda *frames, size=size: size)
        assert least <= ssb_plans.ssb_buckets(t) <= most


def test_hot_parts_are_found_once(spark, monkeypatch):
    from pyspark.sql import DataFrame

    src = ssb.ssb_tables(Tables(spark, SF_SMALL))
    with monkeypatch.context() as m:
        m.setattr(type(src.lineorder), "count", lambda self: pytest.fail("lines are read again"))
        salted = ssb.spread_hot_parts(src, buckets=8)
    plan = plan_text(salted.lineorder, mode="simple")
    assert isinstance(salted.part, DataFrame) and plan.count("l_orderkey") and plan.count("FileScan") == 2, plan
    assert plan_text(salted.part, mode="simple").count("FileScan") == 1


def test_lines_meet_orders_by_shuffle_and_customers_never(spark):
    from olapkit.operators.star import sales
    from olapkit.plans import warehouse

    t = Tables(spark, SF_SMALL)
    for df in (sales(t), ssb.ssb_tables(t).lineorder, warehouse._snowflake_revenue(t)):
        assert "SortMergeJoin [l_orderkey" in plan_text(df, mode="simple")
    above = plan_text(warehouse._snowflake_revenue(t), mode="simple").split("SortMergeJoin [l_orderkey")[0]
    assert "custkey" not in above


def test_star_equals_snowflake_on_repeated_and_null_keys(spark, tmp_dir):
    for name in TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name in ("orders", "customer", "part"):
            df = df.unionByName(df.limit(5))
        if name == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))
        if name == "lineitem":
            df = df.withColumn("l_orderkey", F.when(F.col("l_linenumber") != 2, F.col("l_orderkey")))
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    assert tuple(plans.queries()["star_equals_snowflake"](spark, tmp_dir).first()) == (0, 0)
