"""Warehouse keys: 3NF profiling and top-k analysis, star ETL, star vs
snowflake, OLAP cube operations (SURVEY §2.3-2.8, §2.10 O-DM7..12)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..operators.lattice import CubeLattice
from ..operators.olap import CubeQuery, materialize_cube
from ..operators.quality import multiset_diff
from ..operators.star import (REVENUE, Star, build_dim_customer, build_dim_date, build_dim_item, build_dim_store,
                              build_fact, build_star, customer_geo, read_star, sales, supplier_geo, write_star)
from ..session import scratch_path
from ..sources.readers import Tables
from ..sources.stored import stored
from ..sources.writers import write_parquet
from .registry import query
from .sqlbits import DIM_CUSTOMER, DIM_DATE, DIM_ITEM, DIM_STORE, FACT, SALE, STAR, with_ctes

STAR_INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
PROFILE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _rev(col="amt", name="revenue"):
    return F.sum(col).cast(REVENUE).alias(name)


def stored_star(t: Tables) -> Star:
    """The star of the tables as they are now, built once and read back.

    ETL once, query many: the 3NF join that makes the fact runs one time, the
    star is written to the shared folder with the fact partitioned by year,
    and every OLAP/star query reads it, letting date filters prune fact
    partitions. Changed tables (snapshot of their files) get a new star.
    """
    def build() -> Star:
        path = scratch_path(t.spark, "star")
        write_star(build_star(t), path)
        return read_star(t.spark, path)

    return stored("star", [t.get(n) for n in STAR_INPUTS], build)


# ---------------------------------------------------------------- 3NF profile
@query("table_sizes", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in PROFILE_TABLES))
def table_sizes(t: Tables):
    """Row count per table (O-A1): one unioned frame, one job."""
    parts = [t.get(n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in PROFILE_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("time_span", "SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders")
def time_span(t: Tables):
    """Global min/max (O-A2)."""
    return t.orders.agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@query("project_limit", "SELECT p_partkey, p_name, p_type FROM part ORDER BY p_partkey LIMIT 5")
def project_limit(t: Tables):
    """Projection + ORDER BY + LIMIT (O-P1, O-L2)."""
    return t.part.select("p_partkey", "p_name", "p_type").orderBy("p_partkey").limit(5)


@query("point_lookup", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 2")
def point_lookup(t: Tables):
    """Equality filter pushed into the scan (O-P5)."""
    return t.orders.filter(F.col("o_custkey") == 2).select("o_orderkey", "o_totalprice")


@query("addresses_by_district", """
SELECT c_mktsegment AS district, count(c_name) AS n_customers FROM customer
GROUP BY c_mktsegment ORDER BY n_customers DESC, district LIMIT 10""")
def addresses_by_district(t: Tables):
    """count(col) per group, top 10 (O-A5)."""
    return (t.customer.groupBy(F.col("c_mktsegment").alias("district"))
            .agg(F.count("c_name").alias("n_customers"))
            .orderBy(F.desc("n_customers"), "district").limit(10))


@query("join_two", """
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey, l.l_suppkey
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def join_two(t: Tables):
    """Two-table inner equi-join (O-J1)."""
    o, li = t.orders, t.lineitem
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "l_suppkey"))


@query("payment_item", with_ctes(SALE) + """
SELECT p.p_name AS title, s.amt AS amount, s.o_orderdate AS payment_date, s.o_custkey AS customer_id
FROM sale s JOIN part p ON s.l_partkey = p.p_partkey""")
def payment_item(t: Tables):
    """Item of every sale: lineitem ⋈ orders ⋈ part (O-J2)."""
    s, p = sales(t), t.part
    return s.join(p, s.l_partkey == p.p_partkey).select(
        F.col("p_name").alias("title"), F.col("amt").alias("amount"),
        F.col("o_orderdate").alias("payment_date"), F.col("o_custkey").alias("customer_id"))


@query("payment_city", """
SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id,
       CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount, n.n_name AS city
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
ORDER BY o.o_orderdate, o.o_orderkey LIMIT 10""")
def payment_city(t: Tables):
    """City of each payment, first 10 by date (O-J2, O-L3)."""
    o, c, n = t.orders, t.customer, t.nation
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .orderBy("o_orderdate", "o_orderkey").limit(10)
            .select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("amount"), F.col("n_name").alias("city")))


@query("snowflake_detail", with_ctes(SALE) + """
SELECT p.p_name AS title, s.amt AS amount, s.o_custkey AS customer_id, n.n_name AS city,
       r.r_name AS country, s.o_orderdate AS payment_date, CAST(month(s.o_orderdate) AS INTEGER) AS month
FROM sale s JOIN part p ON s.l_partkey = p.p_partkey
JOIN customer c ON s.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
ORDER BY s.o_orderdate, s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.amt LIMIT 10""")
def snowflake_detail(t: Tables):
    """Five-table 3NF chain with month, first 10 rows in a total order (O-J2)."""
    s, p = sales(t), t.part
    g = customer_geo(t)
    return (s.join(p, s.l_partkey == p.p_partkey).join(g, s.o_custkey == g.c_custkey)
            .orderBy("o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "amt").limit(10)
            .select(F.col("p_name").alias("title"), F.col("amt").alias("amount"),
                    F.col("o_custkey").alias("customer_id"), F.col("n_name").alias("city"),
                    F.col("r_name").alias("country"), F.col("o_orderdate").alias("payment_date"),
                    F.month("o_orderdate").alias("month")))


@query("top_items_revenue", with_ctes(SALE) + """
SELECT p.p_name AS title, CAST(sum(s.amt) AS DECIMAL(38,2)) AS revenue
FROM sale s JOIN part p ON s.l_partkey = p.p_partkey
GROUP BY p.p_name ORDER BY revenue DESC, title LIMIT 10""")
def top_items_revenue(t: Tables):
    """Revenue per item name, top 10 (O-A4, O-L3)."""
    s, p = sales(t), t.part
    return (s.join(p, s.l_partkey == p.p_partkey).groupBy(F.col("p_name").alias("title"))
            .agg(_rev()).orderBy(F.desc("revenue"), "title").limit(10))


@query("top_items_by_key", with_ctes(SALE) + """
SELECT p.p_partkey AS item_id, p.p_name AS title, CAST(sum(s.amt) AS DECIMAL(38,2)) AS revenue
FROM sale s JOIN part p ON s.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name ORDER BY revenue DESC, item_id LIMIT 10""")
def top_items_by_key(t: Tables):
    """Revenue per item key with its label in the grouping (O-A17)."""
    s, p = sales(t), t.part
    return (s.join(p, s.l_partkey == p.p_partkey)
            .groupBy(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
            .agg(_rev()).orderBy(F.desc("revenue"), "item_id").limit(10))


@query("top_cities_revenue", with_ctes(SALE) + """
SELECT n.n_name AS city, CAST(sum(s.amt) AS DECIMAL(38,2)) AS revenue
FROM sale s JOIN customer c ON s.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY revenue DESC, city LIMIT 10""")
def top_cities_revenue(t: Tables):
    """Revenue per customer city, top 10."""
    s, c, n = sales(t), t.customer, t.nation
    return (s.join(c, s.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("city")).agg(_rev())
            .orderBy(F.desc("revenue"), "city").limit(10))


@query("revenue_by_month", with_ctes(SALE) + """
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(sum(amt) AS DECIMAL(38,2)) AS revenue
FROM sale GROUP BY month ORDER BY revenue DESC, month""")
def revenue_by_month(t: Tables):
    """Group by an output alias (O-A16)."""
    return (sales(t).groupBy(F.month("o_orderdate").alias("month")).agg(_rev())
            .orderBy(F.desc("revenue"), "month"))


@query("role_playing_left_join", """
SELECT (SELECT n_name FROM nation, customer WHERE n_nationkey = c_nationkey AND c_custkey = o_custkey) AS customer_nation,
       (SELECT n_name FROM nation, supplier WHERE n_nationkey = s_nationkey
        AND s_suppkey = if(l_linenumber % 5 = 0, -l_suppkey - 1, l_suppkey)) AS supplier_nation, count(*) AS n_sales
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""")
def role_playing_left_join(t: Tables):
    """One lookup table in two roles: customer nation (inner) and supplier
    nation (left outer). Every fifth line of an order names a supplier that
    does not exist, whose nation stays NULL (O-J5)."""
    s, c = sales(t), t.customer
    supplier = F.when(F.col("l_linenumber") % 5 == 0, -F.col("l_suppkey") - 1).otherwise(F.col("l_suppkey"))
    buyers = c.join(t.nation, c.c_nationkey == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("customer_nation"))
    sellers = supplier_geo(t).select(F.col("s_suppkey").alias("seller"), F.col("n_name").alias("supplier_nation"))
    return (s.withColumn("seller", supplier).join(buyers, "o_custkey").join(sellers, "seller", "left")
            .groupBy("customer_nation", "supplier_nation").agg(F.count(F.lit(1)).alias("n_sales")))


# ------------------------------------------------------------------ star ETL
@query("dim_date", with_ctes(DIM_DATE) + "SELECT * FROM dim_date")
def dim_date(t: Tables):
    return build_dim_date(t.orders, "o_orderdate")


@query("dim_customer", with_ctes(DIM_CUSTOMER) + "SELECT * FROM dim_customer")
def dim_customer(t: Tables):
    return build_dim_customer(t)


@query("dim_item", with_ctes(DIM_ITEM) + "SELECT * FROM dim_item")
def dim_item(t: Tables):
    return build_dim_item(t)


@query("dim_store", with_ctes(DIM_STORE) + "SELECT * FROM dim_store")
def dim_store(t: Tables):
    return build_dim_store(t)


@query("fact_sales", with_ctes(FACT) + "SELECT * FROM fact")
def fact_sales(t: Tables):
    return build_fact(t)


# ---------------------------------------------------------- star vs snowflake
@query("star_detail", with_ctes(STAR) + """
SELECT i.title, d.month, c.city, f.sales_amount
FROM fact f JOIN dim_item i ON i.item_key = f.item_key
JOIN dim_date d ON d.date_key = f.date_key
JOIN dim_customer c ON c.customer_key = f.customer_key
ORDER BY f.date_key, f.order_key, f.line_number, f.item_key, f.store_key, f.sales_amount LIMIT 10""")
def star_detail(t: Tables):
    """Fact joined with dimensions, keys replaced by labels (O-J3)."""
    st = stored_star(t)
    f = st.fact
    return (f.join(st.item.select("item_key", "title"), "item_key")
            .join(st.date.select("date_key", "month"), "date_key")
            .join(st.customer.select("customer_key", "city"), "customer_key")
            .orderBy("date_key", "order_key", "line_number", "item_key", "store_key", "sales_amount")
            .limit(10).select("title", "month", "city", "sales_amount"))


STAR_REVENUE_SQL = with_ctes(STAR) + """
SELECT i.title, d.month, c.city, CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS revenue
FROM fact f JOIN dim_item i ON i.item_key = f.item_key
JOIN dim_date d ON d.date_key = f.date_key
JOIN dim_customer c ON c.customer_key = f.customer_key
GROUP BY i.title, d.month, c.city"""

SNOWFLAKE_REVENUE_SQL = with_ctes(SALE) + """
SELECT p.p_name AS title, CAST(month(s.o_orderdate) AS SMALLINT) AS month, n.n_name AS city,
       CAST(sum(s.amt) AS DECIMAL(38,2)) AS revenue
FROM sale s JOIN part p ON s.l_partkey = p.p_partkey
JOIN customer c ON s.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY p.p_name, month(s.o_orderdate), n.n_name"""


@query("star_revenue", STAR_REVENUE_SQL)
def star_revenue(t: Tables):
    """Revenue by item, month and city from the star (O-J3, O-DM12)."""
    return CubeQuery(stored_star(t)).by("title", "month", "city").frame()


def _snowflake_revenue(t: Tables):
    """Orders meet their customer's city before they meet the lines, which are many more: the lines are then shuffled by
    order and, if parts are many, by part, and never by customer."""
    o, c, n, r, p = t.orders, t.customer, t.nation, t.region, t.part
    placed = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey).select("o_orderkey", "o_orderdate", "n_name"))
    s = sales(t, placed)
    return (s.join(p, s.l_partkey == p.p_partkey)
            .groupBy(F.col("p_name").alias("title"), F.month("o_orderdate").cast("smallint").alias("month"),
                     F.col("n_name").alias("city"))
            .agg(_rev()))


@query("snowflake_revenue", SNOWFLAKE_REVENUE_SQL)
def snowflake_revenue(t: Tables):
    """The same answer from the 3NF tables (O-DM12)."""
    return _snowflake_revenue(t)


@query("star_equals_snowflake", f"""
WITH star_q AS ({STAR_REVENUE_SQL}), snow_q AS ({SNOWFLAKE_REVENUE_SQL})
SELECT (SELECT count(*) FROM (SELECT * FROM star_q EXCEPT ALL SELECT * FROM snow_q) a) AS star_minus_snowflake,
       (SELECT count(*) FROM (SELECT * FROM snow_q EXCEPT ALL SELECT * FROM star_q) b) AS snowflake_minus_star""")
def star_equals_snowflake(t: Tables):
    """Differences both ways between the star and the 3NF answer: (0, 0)."""
    cols = ["title", "month", "city", "revenue"]
    diff = multiset_diff(star_revenue(t).select(*cols), _snowflake_revenue(t).select(*cols))
    side = lambda sign: F.coalesce(F.sum(F.greatest(F.lit(0), sign * F.col("_surplus"))), F.lit(0))
    return diff.agg(side(1).alias("star_minus_snowflake"), side(-1).alias("snowflake_minus_star"))


# ------------------------------------------------------------------ OLAP cube
def _cube(t: Tables) -> CubeQuery:
    return CubeQuery(stored_star(t))


@query("total_revenue", with_ctes(FACT) + "SELECT CAST(sum(sales_amount) AS DECIMAL(38,2)) AS revenue FROM fact")
def total_revenue(t: Tables):
    return _cube(t).frame()


@query("revenue_by_country", with_ctes(FACT, DIM_STORE) + """
SELECT st.country, CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS revenue
FROM fact f JOIN dim_store st ON f.store_key = st.store_key GROUP BY st.country""")
def revenue_by_country(t: Tables):
    return _cube(t).by("store_country").frame().withColumnRenamed("store_country", "country")


@query("revenue_month_country", with_ctes(FACT, DIM_DATE, DIM_STORE) + """
SELECT d.month, st.country, CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS revenue
FROM fact f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_store st ON f.store_key = st.store_key
GROUP BY d.month, st.country""")
def revenue_month_country(t: Tables):
    """One grouping of the month × country cube (O-O6)."""
    return (_cube(t).by("month", "store_country").frame()
            .withColumnRenamed("store_country", "country"))


# The oracles of the cube operations state each question over the source
# tables: one row per sale with the levels that are asked for.
_SALES_BY_LEVEL = """WITH sold AS (
  SELECT CAST(extract('day' FROM o_orderdate) AS SMALLINT) AS day, CAST(extract('month' FROM o_orderdate) AS SMALLINT) AS month,
         p_type AS rating, c_mktsegment AS district, buyer.n_name AS city, home.r_name AS country,
         shop.r_name AS store_country, CAST(l_extendedprice AS DECIMAL(12,2)) AS paid
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey JOIN nation AS buyer ON buyer.n_nationkey = c_nationkey
  JOIN region AS home ON home.r_regionkey = buyer.n_regionkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation AS seller ON seller.n_nationkey = s_nationkey
  JOIN region AS shop ON shop.r_regionkey = seller.n_regionkey)
"""


def _levels_sql(levels: str, where: str = "true", top: int | None = None) -> str:
    best = f"QUALIFY row_number() OVER (ORDER BY revenue DESC, {levels}) <= {top}" if top else ""
    return (f"{_SALES_BY_LEVEL}SELECT {levels}, CAST(sum(paid) AS DECIMAL(38,2)) AS revenue FROM sold "
            f"WHERE {where} GROUP BY {levels} {best}")


@query("olap_base", _levels_sql("day, rating, city", top=20))
def olap_base(t: Tables):
    """Revenue by day, rating and city, top 20 (O-O1)."""
    return _cube(t).by("day", "rating", "city").top(20)


@query("olap_slice", _levels_sql("day, rating, city", "rating = 'ECONOMY'", 10))
def olap_slice(t: Tables):
    """Slice: one rating (O-O2)."""
    return _cube(t).by("day", "rating", "city").slice("rating", "ECONOMY").top(10)


@query("olap_dice", _levels_sql(
    "day, rating, city", "(rating, city) IN (SELECT * FROM (VALUES ('ECONOMY'), ('PROMO')), (VALUES ('NATION_1'), "
    "('NATION_5'))) AND list_contains([1, 15, 30], day)"))
def olap_dice(t: Tables):
    """Dice: values on three dimensions (O-O3)."""
    return (_cube(t).by("day", "rating", "city")
            .dice({"rating": ["ECONOMY", "PROMO"], "city": ["NATION_1", "NATION_5"], "day": [1, 15, 30]})
            .frame())


@query("olap_rollup", _levels_sql("day, rating, country", top=10))
def olap_rollup(t: Tables):
    """Roll-up city -> country (O-O4)."""
    return _cube(t).by("day", "rating", "city").rollup_to("city", "country").top(10)


@query("olap_drilldown", _levels_sql("day, rating, district", top=10))
def olap_drilldown(t: Tables):
    """Drill-down city -> district (O-O5)."""
    return _cube(t).by("day", "rating", "city").drill_to("city", "district").top(10)


# Every grouping of month and country, marked by its id (1: country summed up,
# 2: month summed up).
_ALL_GROUPINGS = _SALES_BY_LEVEL + """, lattice AS (
  SELECT if(id & 2 = 2, NULL, month) AS month, if(id & 1 = 1, NULL, store_country) AS country, id, paid
  FROM sold, (SELECT unnest(range(4)) AS id))
"""


def _groupings_sql(extra: str = "", month: str = "month") -> str:
    return (f"{_ALL_GROUPINGS}SELECT {month} AS month, country, CAST(sum(paid) AS DECIMAL(38,2)) AS revenue{extra} "
            "FROM lattice GROUP BY lattice.month, country, id")


def _month_country(df):
    return (df.withColumnRenamed("store_country", "country")
            .orderBy(F.asc_nulls_last("month"), F.asc_nulls_last("country"), F.desc("revenue")))


@query("olap_grouping_sets", _groupings_sql())
def olap_grouping_sets(t: Tables):
    """Four groupings in one aggregation (O-A13)."""
    return _month_country(_cube(t).grouping_sets(
        [[], ["month"], ["store_country"], ["month", "store_country"]]))


@query("olap_cube", _groupings_sql())
def olap_cube(t: Tables):
    """CUBE of month × country (O-A14)."""
    return _month_country(_cube(t).cube("month", "store_country"))


@query("olap_cube_gid", _groupings_sql(", CAST(id AS BIGINT) AS grouping_id"))
def olap_cube_gid(t: Tables):
    """CUBE with ``grouping_id`` so grouping NULLs differ from data NULLs."""
    return _month_country(_cube(t).cube("month", "store_country", with_id=True))


@query("stored_cube", _groupings_sql(", CAST(id AS BIGINT) AS grouping_id") + " HAVING id IN (1, 3)")
def stored_cube(t: Tables):
    """The cube computed once, stored by grouping, and queried later: revenue
    per month and in all, read from two of its folders (O-O8)."""
    def build():
        cube = _cube(t).cube("month", "store_country", with_id=True).withColumnRenamed("store_country", "country")
        return materialize_cube(cube, scratch_path(t.spark, "cube"))

    cube = stored("cube", [t.get(n) for n in STAR_INPUTS], build)
    return cube.where(F.col("grouping_id").isin(1, 3)).withColumn("grouping_id", F.col("grouping_id").cast("bigint"))


LATTICE_LEVELS = ["month", "rating", "city", "country", "store_country"]


def stored_lattice(t: Tables) -> CubeLattice:
    """A lattice of revenue over five levels with three cuboids beside the finest; the sales up to 1997 first, the rest as
    a delta that is given twice. The sales meet their dimensions once: the joined rows are stored by year, and the choice
    of cuboids and every delta read these."""
    def build() -> CubeLattice:
        path = scratch_path(t.spark, "lattice-facts")
        joined = _cube(t).joined(["year", *LATTICE_LEVELS]).select("year", *LATTICE_LEVELS, "sales_amount", "customer_key")
        write_parquet(joined, path, partition_by=["year"])
        facts = t.spark.read.schema(joined.schema).parquet(path)
        lattice = CubeLattice(t.spark, scratch_path(t.spark, "lattice"), LATTICE_LEVELS, "sales_amount", "customer_key",
                              implies={"city": ["country"]})
        lattice.plan(facts, 3)
        lattice.add(facts.where("year <= 1997"), "to-1997")
        for _ in range(2):
            lattice.add(facts.where("year > 1997"), "from-1998")
        return lattice

    return stored("lattice", [t.get(n) for n in STAR_INPUTS], build)


@query("cube_lattice", _SALES_BY_LEVEL + """
SELECT month, country, store_country, CAST(sum(paid) AS DECIMAL(38,2)) AS revenue, count(*) AS n
FROM sold GROUP BY GROUPING SETS ((month, store_country), (country), (country, store_country), ())""")
def cube_lattice(t: Tables):
    """Four groupings answered from stored cuboids, after a delta (O-O8)."""
    lattice, out = stored_lattice(t), []
    for g in (["month", "store_country"], ["country"], ["country", "store_country"], []):
        cols = [F.col(c) if c in g else F.lit(None).cast(lattice.types[c].dataType).alias(c)
                for c in ("month", "country", "store_country")]
        out.append(lattice.answer(*g).select(*cols, F.col("total").alias("revenue"), "n"))
    return functools.reduce(lambda a, b: a.unionByName(b), out)


@query("cube_lattice_distinct", with_ctes(FACT, DIM_STORE) + """
SELECT st.country AS store_country, count(DISTINCT f.customer_key) AS customers, true AS near
FROM fact f JOIN dim_store st ON f.store_key = st.store_key GROUP BY st.country""")
def cube_lattice_distinct(t: Tables):
    """Distinct buyers per store country: exact from the facts, and whether the stored sketches are within 8 percent, five
    of their standard errors (O-A7, O-O8)."""
    exact = _cube(t).joined(["store_country"]).groupBy("store_country").agg(F.count_distinct("customer_key").alias("customers"))
    about = stored_lattice(t).answer("store_country").select("store_country", "distinct")
    return exact.join(about, "store_country").select("store_country", "customers", (
        F.abs(F.col("distinct") - F.col("customers")) <= F.ceil(F.col("customers") * 0.08)).alias("near"))


@query("olap_cube_naive", _groupings_sql(month="CAST(lattice.month AS VARCHAR)"))
def olap_cube_naive(t: Tables):
    """The cube as four aggregates glued with UNION ALL, month as text (O-A15, O-L6)."""
    return (_cube(t).naive_union("month", "store_country", as_text=["month"])
            .withColumnRenamed("store_country", "country"))
