"""3NF -> star schema ETL: date, customer, item and store dimensions plus a
sales fact (O-DM7..O-DM12, O-K4).

On the driver's tables: a sale is a ``lineitem`` row joined to its ``orders``
row; customers and suppliers (stores) are flattened with ``nation`` (city)
and ``region`` (country); parts are the items.

All builders return lazy frames. Joins are written as plain equi-joins: the
planner broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with runtime sizes)
and otherwise shuffles both sides on the key, so no size is assumed here.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, date_parts
from ..sources.readers import Tables

AMOUNT = "decimal(12,2)"       # exact money type for line amounts
REVENUE = "decimal(38,2)"      # result type of revenue sums: no sum over 100 TB of sales leaves it
DEFAULT_LOAD_DATE = _dt.datetime(2024, 1, 1)


def amount(col: str = "l_extendedprice"):
    return F.col(col).cast(AMOUNT)


def revenue_sum(col: str = "sales_amount", name: str = "revenue"):
    return F.sum(col).cast(REVENUE).alias(name)


def sales(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Line items with their order (payment ⋈ rental ⋈ inventory analogue), or with ``orders`` that have more columns.

    Orders grow with their lines, so both sides are shuffled at every size: orders small enough to be broadcast would
    pass whole through the driver, and the join would change its form as the tables grow."""
    li = t.lineitem
    o = t.orders if orders is None else orders
    return li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).withColumn("amt", amount())


def customer_geo(t: Tables) -> DataFrame:
    """customer → nation (city) → region (country)."""
    c, n, r = t.customer, t.nation, t.region
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))


def supplier_geo(t: Tables) -> DataFrame:
    """supplier → nation (city) → region (country)."""
    s, n, r = t.supplier, t.nation, t.region
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))


def _load_ts(load_date):
    """Fixed load timestamp (``now()`` in the reference) so reruns repeat."""
    if isinstance(load_date, _dt.datetime):
        load_date = load_date.isoformat(sep=" ")
    return F.lit(str(load_date)).cast("timestamp_ntz")


def build_dim_date(df: DataFrame, ts_col: str) -> DataFrame:
    """One row per calendar date present in ``ts_col`` (O-DM7).

    Dates are made distinct first (partial aggregation before the shuffle,
    one narrow column), then the calendar attributes are derived.
    """
    days = df.select(F.to_date(ts_col).alias("_d")).distinct()
    return days.select(*date_parts(F.col("_d")))


def build_dim_customer(t: Tables, load_date=DEFAULT_LOAD_DATE) -> DataFrame:
    """Flattened customer dimension with validity dates (O-DM8)."""
    ld = _load_ts(load_date)
    return customer_geo(t).select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("district"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("c_acctbal").alias("acctbal"),
        ld.alias("start_date"),
        ld.alias("end_date"),
    )


def build_dim_item(t: Tables) -> DataFrame:
    """Item dimension (O-DM9). One lookup table is joined twice: every item
    has a nation it is made in (inner join), and may have one it was designed
    in (left join, else NULL)."""
    made = t.nation.select(F.col("n_nationkey").alias("_made"), F.col("n_name").alias("made_in"))
    designed = t.nation.select(F.col("n_nationkey").alias("_designed"), F.col("n_name").alias("designed_in"))
    p = t.part
    return p.join(made, p.p_partkey % 25 == F.col("_made")).join(designed, p.p_size == F.col("_designed"), "left").select(
        F.col("p_partkey").alias("item_key"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("rating"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail_price"),
        "made_in",
        "designed_in",
    )


def build_dim_store(t: Tables, load_date=DEFAULT_LOAD_DATE) -> DataFrame:
    """Store dimension from supplier, its nation and region (O-DM10)."""
    ld = _load_ts(load_date)
    return supplier_geo(t).select(
        F.col("s_suppkey").alias("store_key"),
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("manager_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        ld.alias("start_date"),
        ld.alias("end_date"),
    )


def build_fact(t: Tables) -> DataFrame:
    """Sales fact: natural ids become dimension keys, the order date a date key (O-DM11)."""
    return sales(t).select(
        date_key("o_orderdate").alias("date_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("item_key"),
        F.col("l_suppkey").alias("store_key"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("amt").alias("sales_amount"),
    )


@dataclass
class Star:
    fact: DataFrame
    date: DataFrame
    customer: DataFrame
    item: DataFrame
    store: DataFrame

    TABLES = ("fact", "date", "customer", "item", "store")

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.TABLES}


def build_star(t: Tables, load_date=DEFAULT_LOAD_DATE) -> Star:
    return Star(
        fact=build_fact(t),
        date=build_dim_date(t.orders, "o_orderdate"),
        customer=build_dim_customer(t, load_date),
        item=build_dim_item(t),
        store=build_dim_store(t, load_date),
    )


def write_star(star: Star, out_dir: str, mode: str = "overwrite", num_partitions: int | None = None) -> None:
    """Materialise the star (O-K4): dimensions as plain parquet, the fact
    partitioned by ``year_key`` (year of the sale date).

    Queries that join the fact with the date dimension also join on
    ``year_key`` (see ``CubeQuery``), so a filter on the date dimension
    prunes fact partitions at run time (dynamic partition pruning). The fact
    is range-partitioned on (date_key, order_key) before the write: each task
    writes one contiguous, sorted date range into one or two year
    directories (few files; date_key min/max per row group stay tight), and a
    busy day is split over several tasks by order key. Yearly rather than
    monthly directories: measured faster for scans without a date filter,
    with the same pruning for year filters.
    """
    out_dir = out_dir.rstrip("/")
    for name, df in star.tables().items():
        if name == "fact":
            by = ["date_key", "order_key"]
            df = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
            df = (df.sortWithinPartitions("date_key", "order_key")
                  .withColumn("year_key", year_key("date_key")))
            df.write.mode(mode).partitionBy("year_key").parquet(f"{out_dir}/{name}")
        else:
            df.write.mode(mode).parquet(f"{out_dir}/{name}")


def year_key(date_key_col: str = "date_key"):
    """yyyy of a yyyyMMdd integer key."""
    return (F.col(date_key_col) / 10000).cast("int")


def read_star(spark, out_dir: str) -> Star:
    out_dir = out_dir.rstrip("/")
    return Star(**{n: spark.read.parquet(f"{out_dir}/{n}") for n in Star.TABLES})
