"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps (as in the reference's table-design exercise): load the SSB tables in
two layouts (``plain`` and ``dist``: partitioned, bucketed, sorted), time each
load; bulk-load delimited gz files; materialise the star; then time each headline query: one warm-up, then the
median of ``BENCH_RUNS`` (default 5) runs. Queries run to completion into
the ``noop`` sink, so nothing is collected on the driver. With ``BENCH_ALL=1``
(default) every registered key is also timed once after a warm-up
(``all_keys``, not part of the headline total). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    scratch = tempfile.mkdtemp(prefix="olapkit-bench-", dir=os.environ.get("OLAPKIT_SCRATCH", "/tmp"))

    from pyspark.sql import SparkSession

    from olapkit import plans
    from olapkit.operators.olap import CubeQuery
    from olapkit.operators.ssb import DIST_LAYOUT, SsbTables, compare_layouts, spread_hot_parts, ssb_tables
    from olapkit.operators.star import build_star, read_star, write_star
    from olapkit.session import JOB_CONF, LOCAL_CONF, configure
    from olapkit.sources.readers import Tables, bulk_load
    from olapkit.sources.writers import load_tables

    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("olapkit-bench")
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
               .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2))))
    for k, v in {**LOCAL_CONF, **JOB_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    t = Tables(spark, sf_dir)
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    # ---- loads: SSB tables in both layouts, the star ------------------------
    src = ssb_tables(t)
    layouts = {}
    buckets = max(8, cpus)
    for layout in ("plain", "dist"):
        t0 = time.perf_counter()
        tabs = spread_hot_parts(src, buckets) if layout == "dist" else src
        timings[f"salt_{layout}"] = round(time.perf_counter() - t0, 3)
        loads = load_tables(tabs.as_dict(), f"ssb_{layout}", layout, DIST_LAYOUT, buckets=buckets,
                            location=f"{scratch}/ssb_{layout}")
        for name, sec in loads:
            timings[f"load_{name}_{layout}"] = sec
        layouts[layout] = SsbTables(**{n: spark.table(f"ssb_{layout}.{n}") for n in SsbTables.NAMES})

    # ---- bulk loads of delimited gz files, split and single: rows a second ----
    lines = t.lineitem
    rows = lines.count()
    bulk = {}
    for name, parts in (("split", 4 * cpus), ("single", 1)):
        path = f"{scratch}/bulk_{name}"
        lines.repartition(parts).write.option("sep", ";").option("compression", "gzip").csv(path)
        samples = []
        for _ in range(3):
            t0 = time.perf_counter()
            bulk_load(spark, path, lines.schema).write.mode("overwrite").parquet(f"{path}_table")
            samples.append(time.perf_counter() - t0)
        timings[f"bulk_load_{name}"] = round(min(samples), 3)
        bulk[name] = round(rows / min(samples))
    timed("load_star", lambda: write_star(build_star(t), f"{scratch}/star"))
    star = read_star(spark, f"{scratch}/star")

    # ---- queries -------------------------------------------------------------------
    def run(df):
        df.write.format("noop").mode("overwrite").save()

    q = plans.queries()
    cube = CubeQuery(star)
    medians = {}
    layout_gain = {}
    for row in compare_layouts(spark, layouts, runs=runs):
        medians[f"ssb_{row['query']}_{row['layout']}"] = row["seconds"]
        if row["layout"] == "dist":
            layout_gain[row["query"]] = row["gain_pct"]
    bench_queries = {
        "star_revenue": lambda: cube.by("title", "month", "city").frame(),
        "snowflake_revenue": lambda: q["snowflake_revenue"](spark, sf_dir),
        "olap_cube": lambda: cube.cube("month", "store_country"),
        "olap_cube_naive": lambda: cube.naive_union("month", "store_country", as_text=["month"]),
        "olap_base": lambda: cube.by("day", "rating", "city").top(20),
        "phase_by_flag": lambda: q["phase_by_flag"](spark, sf_dir),
        "sessions_sql": lambda: q["sessions_sql"](spark, sf_dir),
        "log_parse": lambda: q["log_parse"](spark, sf_dir),
        "upsert_latest": lambda: q["upsert_latest"](spark, sf_dir),
        "fk_orphans": lambda: q["fk_orphans"](spark, sf_dir),
    }
    for name, make in bench_queries.items():
        run(make())  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            run(make())
            samples.append(time.perf_counter() - t0)
        medians[name] = round(statistics.median(samples), 3)

    # every registered key once (after a warm-up), reported apart from the headline total
    all_keys = {}
    if os.environ.get("BENCH_ALL", "1") == "1":
        for name, fn in q.items():
            run(fn(spark, sf_dir))
            t0 = time.perf_counter()
            run(fn(spark, sf_dir))
            all_keys[name] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "headline_query_median_total",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "loads": timings,
        "bulk_load_rows_per_sec": bulk,
        "layout_gain_pct": layout_gain,
        "all_keys": all_keys,
        "all_keys_total": round(sum(all_keys.values()), 3),
        "runs": runs,
        "cpus": cpus,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
