"""Measure how a hot key spreads over tasks, from Spark's event log.

    python tools/skew_check.py [--sf /root/testdata/sf0.1]

Makes one user own a third of the events, then runs (a) the plain per-user
window and (b) ``running_sum`` (hot timelines cut at time quantiles),
and reports the largest and median shuffle-read record count per task of each
job, read from the event log written to a scratch folder.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_reads(log_dir: str) -> dict[str, list[int]]:
    """job group -> shuffle records read per task (all stages of its jobs)."""
    stage_group, per_stage = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "other")
                    for sid in ev["Stage IDs"]:
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_stage.setdefault(ev["Stage ID"], []).append(recs)
    out: dict[str, list[int]] = {}
    for sid, recs in per_stage.items():
        out.setdefault(stage_group.get(sid, "other"), []).extend(r for r in recs if r > 0)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    scratch = tempfile.mkdtemp(prefix="olapkit-skew-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir)
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from olapkit.operators.events import flag_phase
    from olapkit.session import JOB_CONF, configure

    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ev = spark.read.parquet(f"{args.sf}/events.parquet")
    # one user owns a third of all events
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    flagged = hot.withColumn("flagged", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    w = (Window.partitionBy("user_id").orderBy(F.col("ts").desc())
         .rangeBetween(Window.unboundedPreceding, 0))
    sc = spark.sparkContext

    sc.setJobGroup("plain", "plain window")
    plain = flagged.withColumn("phase", F.sum("flagged").over(w))
    plain.write.format("noop").mode("overwrite").save()
    # the bound below which no user is hot is scaled down to this data size
    sc.setJobGroup("chunked_counts", "users counted, hot timelines cut")
    chunked = flag_phase(hot, "user_id", "ts", F.col("event_type") == "purchase", fewest_hot=5000)
    sc.setJobGroup("chunked", "running_sum")
    chunked.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("compare", "equality check")
    same = plain.select("event_id", "phase").exceptAll(chunked.select("event_id", "phase")).count() == 0
    total = hot.count()

    # upsert with a hot primary key: a third of the line items share one key
    from olapkit.operators.modeling import upsert

    li = spark.read.parquet(f"{args.sf}/lineitem.parquet")
    hot_row = F.col("l_partkey") % 3 == 0
    li = (li.withColumn("l_orderkey", F.when(hot_row, F.lit(-1)).otherwise(F.col("l_orderkey")))
            .withColumn("l_linenumber", F.when(hot_row, F.lit(1)).otherwise(F.col("l_linenumber"))))
    sc.setJobGroup("upsert", "row number cut before the shuffle")
    upsert(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).write.format(
        "noop").mode("overwrite").save()

    # fact ⋈ dimension on the hot user, shuffled (no broadcast): AQE skew join
    # splits the hot partition. Thresholds are scaled down to this data size;
    # on a cluster the defaults (256 MB, 5x median) apply.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "3")
    # the dimension is a stored table, as in a star schema
    sc.setJobGroup("setup", "write user dimension")
    hot.select("user_id").distinct().withColumn("segment", F.col("user_id") % 5) \
        .write.mode("overwrite").parquet(f"{scratch}/users")
    users = spark.read.parquet(f"{scratch}/users")
    # the fact is stored as several files too: AQE splits a skewed partition
    # by ranges of map tasks, so a single-file input could not be split
    hot.select("user_id", "value").repartition(16).write.mode("overwrite").parquet(f"{scratch}/fact")
    fact = spark.read.parquet(f"{scratch}/fact")
    joined = fact.join(users, "user_id").groupBy("segment").agg(F.sum("value").alias("v"))
    for group, on in (("join_skew_split_off", "false"), ("join_skew_split_on", "true")):
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", on)
        sc.setJobGroup(group, group)
        joined.write.format("noop").mode("overwrite").save()
    spark.stop()

    reads = task_reads(log_dir)
    print(f"rows={total} hot_user_rows={(total + 2) // 3} results_equal={same}")
    for group in ("plain", "chunked", "upsert", "join_skew_split_off", "join_skew_split_on"):
        r = reads.get(group, [])
        if r:
            print(f"{group}: shuffle-reading tasks={len(r)} max_records_per_task={max(r)} "
                  f"median={int(statistics.median(r))}")


if __name__ == "__main__":
    main()
