"""Event-log windows and access-log parsing on small inputs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from olapkit.functions.logs import access_log_fields, access_log_map, log_timestamp
from olapkit.operators.events import flag_phase, running_sum, sessionize_by_marker
from olapkit.operators.weblog import parse_access_log, with_typed_size
from olapkit.sources.readers import rows

from .conftest import rows_of

# (event_id, ts, page): FIXTURES A6; the Home at ts=2 has the lower id
TIES = [(0, 1, "Home"), (2, 2, "NextSong"), (1, 2, "Home"), (3, 3, "NextSong")]


def test_range_and_rows_frames_differ_on_ties(spark):
    df = (rows(spark, "event_id long, ts long, page string", TIES)
          .withColumn("user_id", F.lit(1))
          .withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz")))
    home = F.col("page") == "Home"
    rng = sessionize_by_marker(df, "user_id", "ts", home)
    rws = sessionize_by_marker(df, "user_id", "ts", home, frame="rows", tie_break=["event_id"])
    # RANGE: both ts=2 rows share the count of Home rows at or after ts=2
    assert dict(rows_of(rng, ["event_id", "period"])) == {0: 2, 1: 1, 2: 1, 3: 0}
    # ROWS (ts DESC, event_id DESC): the NextSong at ts=2 comes before that Home
    assert dict(rows_of(rws, ["event_id", "period"])) == {0: 2, 1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_chunked_running_sum_equals_plain_window(spark, frame):
    rnd = random.Random(7)
    data = []
    for i in range(600):
        user = rnd.choice([1, 1, 1, 1, 2, 3])          # user 1 is hot
        ts = rnd.randrange(0, 5 * 3600)                # ties are common
        data.append((i, user, ts, rnd.random() < 0.3))
    df = (spark.createDataFrame(data, "event_id long, user_id long, ts long, flag boolean")
          .withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
          .withColumn("v", F.col("flag").cast("int")))
    got = running_sum(df, "v", ["user_id"], "ts", "s", frame=frame, tie_break=["event_id"])
    order = [F.col("ts").desc()] + ([F.col("event_id").desc()] if frame == "rows" else [])
    w = Window.partitionBy("user_id").orderBy(*order)
    w = (w.rangeBetween(Window.unboundedPreceding, 0) if frame == "range"
         else w.rowsBetween(Window.unboundedPreceding, 0))
    want = df.withColumn("s", F.sum("v").over(w).cast("bigint"))
    assert rows_of(got, ["event_id", "s"]) == rows_of(want, ["event_id", "s"])


def test_flag_phase(spark):
    df = rows(spark, "user_id long, ts timestamp_ntz, page string", [])
    assert flag_phase(df, "user_id", "ts", F.col("page") == "x").count() == 0


LINES = [
    '199.120.110.21 - - [01/Jul/1995:00:00:11 -0400] "GET /shuttle/missions/sts-73/sts-73-patch-small.gif '
    'HTTP/1.0" 200 4179',
    'unicomp6.unicomp.net - - [01/Jul/1995:00:00:06 -0400] "GET /shuttle/countdown/ HTTP/1.0" 200 3985',
    'host.a - - [01/Jul/1995:00:00:12 -0400] "GET /img/x.gif HTTP/1.0" 404 -',
    'host.b - - [01/Jul/1995:00:00:13 -0400] "GET /no-protocol" 200 10',
    '',
    'host.c - - [01/Jul/1995:00:00:14 +0200] "GET /zone HTTP/1.0" 200 11',
]


def test_access_log_parse_and_rejects(spark):
    lines = rows(spark, "value string", [(x,) for x in LINES])
    res = parse_access_log(lines)
    assert res.parsed.count() + res.rejected.count() == len(LINES)
    got = rows_of(res.parsed, ["host", "date_time", "method", "endpoint", "protocol", "response_code",
                                "content_size"])
    assert got == [
        ("199.120.110.21", "01/Jul/1995:00:00:11 -0400", "GET",
         "/shuttle/missions/sts-73/sts-73-patch-small.gif", "HTTP/1.0", "200", "4179"),
        ("unicomp6.unicomp.net", "01/Jul/1995:00:00:06 -0400", "GET", "/shuttle/countdown/", "HTTP/1.0", "200",
         "3985"),
    ]
    lenient = parse_access_log(lines, lenient=True).parsed
    assert ("host.a", "0") in rows_of(lenient, ["host", "content_size"])
    ts = res.parsed.select(log_timestamp(F.col("date_time")).alias("t")).orderBy("t").first()["t"]
    assert str(ts) == "1995-07-01 04:00:06"
    typed = with_typed_size(lenient).filter("host = 'host.a'").first()
    assert typed["content_size_int"] == 0


def test_access_log_map_is_null_on_no_match(spark):
    lines = rows(spark, "value string", [(LINES[0],), ("garbage",)])
    m = lines.select(access_log_map(F.col("value")).alias("parsed"))
    got = sorted((r["parsed"] or {}).get("host", "<none>") for r in m.collect())
    assert got == ["199.120.110.21", "<none>"]
    assert len(access_log_fields(F.col("value"))) == 9


def test_running_sum_keeps_null_users(spark):
    df = spark.createDataFrame([(1, None, 10, 1), (2, None, 20, 1), (3, 5, 10, 1)],
                               "event_id long, user_id long, ts long, v int") \
        .withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    got = dict(rows_of(running_sum(df, "v", ["user_id"], "ts", "s"), ["event_id", "s"]))
    assert got == {1: 2, 2: 1, 3: 1}


def test_access_log_from_gz_text_file(spark, tmp_dir):
    import gzip

    from olapkit.sources.readers import read_log_lines

    with gzip.open(f"{tmp_dir}/access.log.gz", "wt") as f:
        f.write("\n".join(LINES) + "\n")
    lines = read_log_lines(spark, f"{tmp_dir}/access.log.gz")
    res = parse_access_log(lines)
    assert lines.count() == len(LINES)
    assert res.parsed.count() == 2 and res.rejected.count() == len(LINES) - 2
    top = res.parsed.groupBy("host").count().orderBy(F.desc("count"), "host").first()
    assert top["host"] == "199.120.110.21"


def test_hot_users_are_found_without_a_window(spark, monkeypatch):
    from olapkit.operators import events

    df = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("user"),
                                  F.timestamp_seconds("id").alias("ts"))
    monkeypatch.setattr(events, "Window", None)
    assert [r.user for r in events._hot_bounds(df, ["user"], "ts", 100).collect()] == [1]
    assert events._hot_bounds(df.where("user > 1"), ["user"], "ts", 100) is None
    assert events._hot_bounds(df.where("user < 0"), ["user"], "ts", 100) is None
