"""Keys of dimensions with moving validity dates: two loads of the customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import history
from ..operators.keyed import KeyedTable
from ..session import scratch_path
from ..sources.readers import Tables, sized_count
from ..sources.stored import stored
from .registry import query

FIRST, SECOND = dt.date(1992, 1, 1), dt.date(1996, 1, 1)

# Stand-in loads: every seventh customer comes with the second load, which has another segment for every tenth and lacks
# every 25th.
_FIRST = "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 7 <> 0"
_SECOND = """SELECT c_custkey, if(c_custkey % 10 = 0, 'MOVED', c_mktsegment) AS c_mktsegment, c_nationkey
FROM customer WHERE c_custkey % 25 <> 0"""

_HISTORY = f"""WITH a AS ({_FIRST}), b AS ({_SECOND}), h AS (
  SELECT a.*, DATE '{FIRST}' AS start_date,
         if(b.c_custkey IS NULL OR a.c_mktsegment <> b.c_mktsegment, DATE '{SECOND}', NULL) AS end_date
  FROM a LEFT JOIN b USING (c_custkey)
  UNION ALL SELECT b.*, DATE '{SECOND}', NULL FROM b LEFT JOIN a USING (c_custkey)
  WHERE a.c_custkey IS NULL OR a.c_mktsegment <> b.c_mktsegment)
"""


def customer_history(t: Tables):
    """The history after both loads, the second given twice."""
    def build():
        segment = F.when(F.col("c_custkey") % 10 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
        cols = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
        table = KeyedTable(t.spark, scratch_path(t.spark, "customer-history"), ["c_custkey", history.START],
                           sized_count(t.customer, target_bytes=128 << 20))
        history.load(table, cols.where("c_custkey % 7 <> 0"), ["c_custkey"], FIRST)
        for _ in range(2):
            history.load(table, cols.withColumn("c_mktsegment", segment).where("c_custkey % 25 <> 0"), ["c_custkey"], SECOND)
        return table

    return history.valid(stored("customer-history", [t.customer], build).read())


@query("dim_customer_history", _HISTORY + "SELECT * FROM h")
def dim_customer_history(t: Tables):
    """Customers with validity dates after two loads: closed, open and unchanged rows (O-DM8)."""
    return customer_history(t).select("c_custkey", "c_mktsegment", "c_nationkey", "start_date", "end_date")


@query("dim_customer_as_of", _HISTORY + """SELECT c_mktsegment, count(*) AS customers FROM h
WHERE start_date <= DATE '1995-06-30' AND (end_date IS NULL OR end_date > DATE '1995-06-30') GROUP BY c_mktsegment""")
def dim_customer_as_of(t: Tables):
    """Customers per segment as they were on a day (O-DM8)."""
    return history.as_of(customer_history(t), dt.date(1995, 6, 30)).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"))


@query("orders_by_segment_then", _HISTORY + """SELECT c_mktsegment AS segment, count(*) AS orders
FROM orders LEFT JOIN h ON o_custkey = c_custkey AND CAST(o_orderdate AS DATE) >= start_date
  AND (end_date IS NULL OR CAST(o_orderdate AS DATE) < end_date) GROUP BY 1""")
def orders_by_segment_then(t: Tables):
    """Orders by the segment that their customer had on the order's day: an as-of lookup (O-DM8, O-DM11)."""
    found = history.join_as_of(t.orders.select("o_custkey", "o_orderdate"), customer_history(t), "o_custkey", "c_custkey",
                               "o_orderdate")
    return found.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("orders"))
