"""Star-schema benchmark (SSB) tables on the test data, their two physical
layouts, and the four SSB queries (O-Q1..O-Q5, O-K5..O-K7).

``lineorder`` is a line item joined with its order; ``dwdate`` is the date
dimension of the order dates. The first query is a comma join with ``WHERE``
equalities over DataFrame parameters of ``spark.sql``; the others join
filtered dimensions. All run on the lazy frames or on written layouts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..sources.readers import Tables
from ..sources.writers import load_tables
from .star import amount, build_dim_date, customer_geo, supplier_geo


@dataclass
class SsbTables:
    lineorder: DataFrame
    dwdate: DataFrame
    part: DataFrame
    supplier: DataFrame
    customer: DataFrame

    NAMES = ("lineorder", "dwdate", "part", "supplier", "customer")

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.NAMES}


def ssb_tables(t: Tables) -> SsbTables:
    li, o = t.lineitem, t.orders
    lineorder = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).select(  # orders grow with the lines: no broadcast
        F.col("l_orderkey").alias("lo_orderkey"),
        F.col("l_linenumber").alias("lo_linenumber"),
        F.col("o_custkey").alias("lo_custkey"),
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        date_key("o_orderdate").alias("lo_orderdate"),
        F.year("o_orderdate").alias("lo_year"),
        F.col("o_orderpriority").alias("lo_orderpriority"),
        F.col("l_quantity").alias("lo_quantity"),
        amount().alias("lo_extendedprice"),
        F.col("l_discount").cast("decimal(4,2)").alias("lo_discount"),
        amount().alias("lo_revenue"),
    )
    d = build_dim_date(o, "o_orderdate")
    dwdate = d.select(
        F.col("date_key").alias("d_datekey"),
        F.col("year").cast("int").alias("d_year"),
        (F.col("date_key") / 100).cast("int").alias("d_yearmonthnum"),
        F.date_format("date", "MMMyyyy").alias("d_yearmonth"),
    )
    part = t.part.select("p_partkey", "p_name", F.col("p_brand").alias("p_brand1"),
                         F.col("p_type").alias("p_category"), "p_size")
    supplier = supplier_geo(t).select("s_suppkey", "s_name", F.col("n_name").alias("s_city"),
                                      F.col("n_name").alias("s_nation"), F.col("r_name").alias("s_region"))
    customer = customer_geo(t).select("c_custkey", "c_name", F.col("n_name").alias("c_city"),
                                      F.col("n_name").alias("c_nation"), F.col("r_name").alias("c_region"),
                                      "c_mktsegment")
    return SsbTables(lineorder, dwdate, part, supplier, customer)


# Layout "dist": the fact is partitioned by order year (a filter on the date
# dimension prunes it at run time), and inside a year distributed on the part
# key and sorted on the order date; part is distributed on the same key
# (co-located join). A hot part key is spread over as many buckets as its own
# lines fill, and its part row is repeated that often (see ``hot_parts``). The other
# dimensions are replicated, which in Spark is the size-checked broadcast of a
# small side.
DIST_LAYOUT = {
    "lineorder": {"partition_by": ["lo_year"], "bucket_by": ["lo_partkey", "lo_salt"], "sort_by": ["lo_orderdate"]},
    "part": {"bucket_by": ["p_partkey", "p_salt"], "sort_by": ["p_partkey"]},
    "supplier": {"sort_by": ["s_suppkey"]},
    "customer": {"sort_by": ["c_custkey"]},
    "dwdate": {"sort_by": ["d_datekey"]},
}


def hot_parts(tables: SsbTables, buckets: int) -> DataFrame:
    """(part, salts): parts with more than half a bucket's mean share of all lines, each with as many salts as it has
    such halves. There are fewer than ``2 * buckets`` of them, and fewer than ``4 * buckets`` salts in all. The number of
    all lines is the sum of the parts' counts, so the lines are read once."""
    lines = tables.lineorder.where("lo_partkey IS NOT NULL").select("lo_partkey")
    counts = lines.groupBy("lo_partkey").agg(F.count(F.lit(1)).alias("n"))
    every = F.broadcast(counts.agg(F.sum("n").alias("lines")))
    halves = F.col("n") * 2 * buckets / F.col("lines")
    return counts.crossJoin(every).where(halves > 1).select(
        F.col("lo_partkey").alias("hot"), F.ceil(halves).cast("int").alias("salts"))


def spread_hot_parts(tables: SsbTables, buckets: int) -> SsbTables:
    """Give every line of a hot part one of the part's salts, and repeat the part's row once per salt; all others have
    salt 0. Both sides meet the table of hot parts, whose size is bounded by the buckets; it is found once for both."""
    found = hot_parts(tables, buckets)
    hot = F.broadcast(found.sparkSession.createDataFrame(found.collect(), found.schema))
    lines = tables.lineorder.join(hot, F.col("lo_partkey") == F.col("hot"), "left")
    salt = F.coalesce(F.pmod(F.hash("lo_orderkey", "lo_linenumber"), F.col("salts")), F.lit(0)).cast("int")
    parts = tables.part.join(hot, F.col("p_partkey") == F.col("hot"), "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0))))
    return replace(tables, lineorder=lines.withColumn("lo_salt", salt).drop("hot", "salts"),
                   part=parts.withColumn("p_salt", every).drop("hot", "salts"))


def materialize(spark: SparkSession, tables: SsbTables, database: str, layout: str,
                buckets: int = 8, location: str | None = None) -> SsbTables:
    """Write the SSB tables into ``database`` in the ``plain`` or ``dist``
    layout (two namespaces of the same tables) and return them."""
    if layout == "dist":
        tables = spread_hot_parts(tables, buckets)
    load_tables(tables.as_dict(), database, layout, DIST_LAYOUT, buckets=buckets, location=location)
    return SsbTables(**{n: spark.table(f"{database}.{n}") for n in SsbTables.NAMES})


# ---- queries ------------------------------------------------------------------
# Revenue of discounted small sales in one year, as a comma join (O-J4).
ONE_DIM = """
SELECT sum(lo_extendedprice * lo_discount)::DECIMAL(38,4) AS revenue
FROM {lineorder}, {dwdate}
WHERE d_datekey = lo_orderdate AND d_year = lo_year AND d_year = 1997
  AND lo_quantity < 24 AND lo_discount BETWEEN 0.01 AND 0.03"""


def _dates(tabs: SsbTables, *conditions: Column) -> DataFrame:
    """Dates named as the fact's keys; the year is the fact's partition column, so conditions prune it."""
    d = tabs.dwdate
    for c in conditions:
        d = d.where(c)
    return d.select(F.col("d_datekey").alias("lo_orderdate"), F.col("d_year").alias("lo_year"))


def _parts(tabs: SsbTables) -> tuple[DataFrame, list[str]]:
    """Parts named as the fact's keys; in the ``dist`` layout the salt is part of the key."""
    keys = {"p_partkey": "lo_partkey"} | ({"p_salt": "lo_salt"} if "p_salt" in tabs.part.columns else {})
    rest = [F.col(c) for c in tabs.part.columns if c not in keys]
    return tabs.part.select(*[F.col(a).alias(b) for a, b in keys.items()], *rest), list(keys.values())


def one_dim(spark: SparkSession, tabs: SsbTables) -> DataFrame:
    return spark.sql(ONE_DIM, lineorder=tabs.lineorder, dwdate=tabs.dwdate)


def two_dim(spark: SparkSession, tabs: SsbTables) -> DataFrame:
    """Revenue per year and brand of one category, sold by suppliers of one region."""
    parts, on = _parts(tabs)
    promo = parts.where("p_category = 'PROMO'").select(*on, F.col("p_brand1").alias("brand"))
    sellers = tabs.supplier.where("s_region = 'AMERICA'").select(F.col("s_suppkey").alias("lo_suppkey"))
    sold = tabs.lineorder.join(promo, on).join(sellers, "lo_suppkey").join(_dates(tabs), ["lo_orderdate", "lo_year"])
    return sold.groupBy(F.col("lo_year").alias("year"), "brand").agg(_money(F.sum("lo_revenue")))


DRILL_CITIES, DRILL_MONTH = ("NATION_1", "NATION_5"), 199712


def drill(spark: SparkSession, tabs: SsbTables) -> DataFrame:
    """Revenue of one month between two cities, by buyer's and seller's city and year."""
    buyers = tabs.customer.where(F.col("c_city").isin(*DRILL_CITIES)).select(
        F.col("c_custkey").alias("lo_custkey"), "c_city")
    sellers = tabs.supplier.where(F.col("s_city").isin(*DRILL_CITIES)).select(
        F.col("s_suppkey").alias("lo_suppkey"), "s_city")
    month = _dates(tabs, F.col("d_yearmonthnum") == DRILL_MONTH)
    sold = tabs.lineorder.join(month, ["lo_orderdate", "lo_year"]).join(buyers, "lo_custkey").join(sellers, "lo_suppkey")
    return (sold.groupBy("c_city", "s_city", F.col("lo_year").alias("year")).agg(_money(F.sum("lo_revenue")))
            .orderBy("year", F.desc("revenue"), "c_city", "s_city"))


def same_dist(spark: SparkSession, tabs: SsbTables) -> DataFrame:
    """Discounts per day, joined on the distribution key."""
    parts, on = _parts(tabs)
    return (tabs.lineorder.join(parts.select(*on), on).groupBy("lo_orderdate")
            .agg(_money(F.sum(F.col("lo_extendedprice") * F.col("lo_discount")), 4)).orderBy("lo_orderdate"))


def _money(total: Column, scale: int = 2) -> Column:
    return total.cast(f"decimal(38,{scale})").alias("revenue")


SSB_QUERIES = {"one_dim": one_dim, "two_dim": two_dim, "drill": drill, "same_dist": same_dist}


def run_ssb(spark: SparkSession, tables: SsbTables, name: str) -> DataFrame:
    return SSB_QUERIES[name](spark, tables)


def compare_layouts(spark: SparkSession, layouts: dict[str, SsbTables], runs: int = 3,
                    names: tuple[str, ...] = tuple(SSB_QUERIES)) -> list[dict]:
    """Time every SSB query on every layout (O-Q5): one warm-up, then the
    median of ``runs``; each query runs to completion into the ``noop`` sink.
    Returns rows ``{query, layout, seconds}`` plus ``gain_pct`` of the second
    layout over the first."""
    import statistics
    import time

    out = []
    for name in names:
        times = {}
        for layout, tabs in layouts.items():
            run_ssb(spark, tabs, name).write.format("noop").mode("overwrite").save()
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                run_ssb(spark, tabs, name).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[layout] = statistics.median(samples)
        base = next(iter(times.values()))
        for layout, sec in times.items():
            out.append({"query": name, "layout": layout, "seconds": round(sec, 3),
                        "gain_pct": round(100.0 * (base - sec) / base, 1) if base else 0.0})
    return out
