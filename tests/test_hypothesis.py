"""Randomised checks of the custom operators against brute force."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from olapkit.operators.events import running_sum
from olapkit.operators.modeling import add_surrogate_key, upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 50), st.integers(0, 9)),
                min_size=0, max_size=60)


@SETTINGS
@given(keys, st.integers(1, 5))
def test_surrogate_key_matches_row_number(spark, data, parts):
    df = spark.createDataFrame(data, "a int, b int, c int, d int") if data else \
        spark.createDataFrame([], "a int, b int, c int, d int")
    df = df.withColumn("uid", F.monotonically_increasing_id())  # unique tie-break
    pdf = df.toPandas()
    got = add_surrogate_key(df, ["c", "a", "uid"], "sk", num_partitions=parts).toPandas()
    want = pdf.sort_values(["c", "a", "uid"]).reset_index(drop=True)
    want["sk"] = range(1, len(want) + 1)
    got = got.sort_values("sk").reset_index(drop=True)
    assert got["uid"].tolist() == want["uid"].tolist()
    assert got["sk"].tolist() == want["sk"].tolist()


@SETTINGS
@given(keys)
def test_upsert_matches_pandas_last_write(spark, data):
    if not data:
        return
    df = spark.createDataFrame(data, "a int, b int, c int, d int")
    got = sorted(tuple(r) for r in upsert(df, ["a"], ["c"]).select("a", "b", "c", "d").collect())
    pdf = pd.DataFrame(data, columns=["a", "b", "c", "d"])
    # order by c, then the remaining columns b, d: the greatest tuple wins
    want = sorted(tuple(int(x) for x in g.sort_values(["c", "b", "d"]).iloc[-1][["a", "b", "c", "d"]])
                  for _, g in pdf.groupby("a"))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 7200), st.booleans()), min_size=1, max_size=50))
def test_running_sum_matches_brute_force(spark, data):
    rows = [(i, u, t, int(f)) for i, (u, t, f) in enumerate(data)]
    df = (spark.createDataFrame(rows, "event_id long, user_id int, ts long, v int")
          .withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz")))
    got = dict((r["event_id"], r["s"]) for r in
               running_sum(df, "v", ["user_id"], "ts", "s", frame="range").collect())
    for i, u, t, _ in rows:   # RANGE, ts DESC: everything of the user at or after t
        assert got[i] == sum(v for _, u2, t2, v in rows if u2 == u and t2 >= t)
