"""SSB keys (O-Q1..O-Q4): the SSB tables are derived from the test tables and
loaded once in the ``dist`` layout; the four SSB queries run on the loaded
tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.ssb import SsbTables, materialize, run_ssb, ssb_tables
from ..session import scratch_path
from ..sources.readers import Tables, sized_count
from ..sources.stored import stored
from .registry import query
from .sqlbits import DATE_KEY

SSB_INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
#: Line items (as stored) per bucket: one task sorts a bucket's some three million rows without spilling. Spark takes no
#: more than 100,000 buckets.
BUCKET_BYTES, MOST_BUCKETS = 48 << 20, 100_000


def ssb_buckets(t: Tables) -> int:
    """Buckets of the ``dist`` layout; a bucket is written, and later sorted and joined, by one task."""
    return min(MOST_BUCKETS, sized_count(t.lineitem, target_bytes=BUCKET_BYTES))


def loaded_ssb(t: Tables, layout: str = "dist") -> SsbTables:
    """SSB tables of the tables as they are now, loaded once per layout into a
    database of their own under the shared folder."""
    def build() -> SsbTables:
        db = f"olapkit_ssb_{layout}_{uuid.uuid4().hex[:10]}"
        return materialize(t.spark, ssb_tables(t), db, layout, buckets=ssb_buckets(t), location=scratch_path(t.spark, db))

    return stored(f"ssb-{layout}", [t.get(n) for n in SSB_INPUTS], build)


# The oracles state each question over the test tables themselves, with
# subqueries in place of the dimension joins.
_FACT = "(FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_TWO_CITIES = "SELECT n_nationkey FROM nation WHERE n_name SIMILAR TO 'NATION_[15]'"
_CITY = "(SELECT n_name FROM nation WHERE n_nationkey = {0})"


@query("ssb_one_dim", f"""
SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(38,4)) AS revenue
FROM {_FACT}
WHERE year(o_orderdate) = 1997 AND l_quantity < 24
  AND CAST(l_discount AS DECIMAL(4,2)) >= 0.01 AND CAST(l_discount AS DECIMAL(4,2)) <= 0.03""")
def ssb_one_dim(t: Tables):
    """One dimension, range filters on the fact (O-Q1, O-J4)."""
    return run_ssb(t.spark, loaded_ssb(t), "one_dim")


@query("ssb_two_dim", f"""
SELECT year(o_orderdate)::INTEGER AS year, (SELECT p_brand FROM part WHERE p_partkey = l_partkey) AS brand,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
FROM {_FACT}
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (
      SELECT n_nationkey FROM nation WHERE n_regionkey = (SELECT r_regionkey FROM region WHERE r_name = 'AMERICA')))
GROUP BY ALL""")
def ssb_two_dim(t: Tables):
    """Two filtered dimensions, grouped by year and brand (O-Q2)."""
    return run_ssb(t.spark, loaded_ssb(t), "two_dim")


@query("ssb_drill", f"""
SELECT {_CITY.format('c_nationkey')} AS c_city, {_CITY.format('s_nationkey')} AS s_city,
       year(o_orderdate)::INTEGER AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
FROM {_FACT} JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
WHERE strftime(o_orderdate, '%Y%m') = '199712' AND c_nationkey IN ({_TWO_CITIES}) AND s_nationkey IN ({_TWO_CITIES})
GROUP BY c_nationkey, s_nationkey, 3""")
def ssb_drill(t: Tables):
    """Three dimensions down to cities and one month (O-Q3)."""
    return run_ssb(t.spark, loaded_ssb(t), "drill")


@query("ssb_same_dist", f"""
SELECT {DATE_KEY.format(c='o_orderdate')} AS lo_orderdate,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(38,4)) AS revenue
FROM {_FACT} WHERE l_partkey IN (SELECT p_partkey FROM part) GROUP BY 1""")
def ssb_same_dist(t: Tables):
    """Join on the distribution key (O-Q4)."""
    return run_ssb(t.spark, loaded_ssb(t), "same_dist")


@query("ssb_layouts", f"""
SELECT layout, year, revenue FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
  FROM {_FACT} GROUP BY 1) CROSS JOIN (VALUES ('plain'), ('dist')) l(layout)""")
def ssb_layouts(t: Tables):
    """The same tables in both layouts, each in its own namespace, give the same totals (O-K5, O-K6, O-K7)."""
    parts = [loaded_ssb(t, layout).lineorder.groupBy(F.col("lo_year").alias("year")).agg(
        F.sum("lo_revenue").cast("decimal(38,2)").alias("revenue")).withColumn("layout", F.lit(layout))
        for layout in ("plain", "dist")]
    return parts[0].unionByName(parts[1])
