"""Data-modelling keys: normal forms on an order/part list,
denormalised reporting tables, one dataset per query (music library on
``orders``), upsert, surrogate keys, typed inserts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import KeyedTable
from ..operators.modeling import (add_surrogate_key, denormalize, extract_dimension, lookup,
                                  materialize_for_query, split_entity, to_1nf, upsert)
from ..operators.star import amount, sales
from ..session import scratch_path
from ..sources.readers import Tables, sized_count
from ..sources.stored import stored
from ..sources.writers import append_batch, insert_into, read_batches
from .registry import query
from .sqlbits import SALE, with_ctes

# --------------------------------------------------------------- normal forms
_NF1_SQL = """SELECT o_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id,
       o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS year, unnest([l_partkey, l_suppkey]) AS code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_PARENT_SQL = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders WHERE EXISTS (FROM lineitem WHERE l_orderkey = o_orderkey)"""

_PRIORITIES_SQL = f"""SELECT row_number() OVER (ORDER BY priority) AS priority_id, priority
FROM (SELECT priority FROM ({_PARENT_SQL}) GROUP BY priority)"""


def order_lines(t: Tables):
    """Unnormalised table: one row per order line, whose part and supplier
    keys share one list cell (an array literal), beside the order's columns."""
    li, o = t.lineitem, t.orders
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("year"), F.array("l_partkey", "l_suppkey").alias("codes"))


def _nf1(t: Tables):
    return to_1nf(order_lines(t), "codes", "code")


def stored_nf1(t: Tables):
    """The 1NF table of the tables as they are now, written once; the 2NF and
    3NF keys split it further instead of joining again."""
    def build():
        path = scratch_path(t.spark, "nf1")
        _nf1(t).write.parquet(path)
        return t.spark.read.parquet(path)

    return stored("nf1", [t.lineitem, t.orders], build)


def _nf2(t: Tables):
    return split_entity(stored_nf1(t), ["order_id"], ["customer_id", "priority", "year"])


def _nf3(t: Tables):
    """(priorities, order headers, codes): written once per state of the tables."""
    def build():
        parent, child = _nf2(t)
        priorities, headers = extract_dimension(parent, "priority", "priority_id")
        return priorities, headers, child

    return stored("nf3", [t.lineitem, t.orders], build)


@query("norm_1nf", _NF1_SQL)
def norm_1nf(t: Tables):
    """1NF: explode the list column of array literals (O-DM1, O-F13)."""
    return _nf1(t)


@query("norm_2nf_parent", _PARENT_SQL)
def norm_2nf_parent(t: Tables):
    """2NF parent: order attributes once per order (O-DM2)."""
    return _nf2(t)[0]


@query("norm_2nf_child", f"SELECT order_id, line_number, code FROM ({_NF1_SQL})")
def norm_2nf_child(t: Tables):
    """2NF child: (order, line, code) rows."""
    return _nf2(t)[1]


@query("norm_3nf_employees", _PRIORITIES_SQL)
def norm_3nf_employees(t: Tables):
    """3NF: the transitively dependent attribute as its own table, ids in name order (O-DM3)."""
    return _nf3(t)[0]


@query("norm_3nf_transactions", f"""
SELECT order_id, customer_id, year, priority_id FROM ({_PARENT_SQL}) JOIN ({_PRIORITIES_SQL}) USING (priority)""")
def norm_3nf_transactions(t: Tables):
    """3NF order headers keep only the id of the priority."""
    return _nf3(t)[1]


@query("norm_rejoin", _NF1_SQL)
def norm_rejoin(t: Tables):
    """Normal forms joined back give the 1NF rows again (O-DM4)."""
    priorities, headers, child = _nf3(t)
    return (headers.join(priorities, "priority_id").join(child, "order_id")
            .select("order_id", "line_number", "customer_id", "priority", "year", "code"))


@query("norm_rejoin_star", """
SELECT o_orderkey AS headers_order_id, o_custkey AS headers_customer_id, o_orderkey AS spend_order_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS spend_amount
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def norm_rejoin_star(t: Tables):
    """``SELECT *`` over a join whose sides share column names: every column
    is prefixed with the name of its side (O-J9)."""
    headers = _nf3(t)[1].select("order_id", "customer_id")
    spend = t.orders.select(F.col("o_orderkey").alias("order_id"), amount("o_totalprice").alias("amount"))
    left = headers.select(*[F.col(c).alias(f"headers_{c}") for c in headers.columns])
    right = spend.select(*[F.col(c).alias(f"spend_{c}") for c in spend.columns])
    return left.join(right, F.col("headers_order_id") == F.col("spend_order_id")).select("*")


# ------------------------------------------------------------ denormalising
@query("denorm_join", """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_orderpriority AS priority,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount_spent
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def denorm_join(t: Tables):
    """Lines with their order's priority and amount: 3NF tables joined (O-J2, O-DM5)."""
    priorities, headers, _ = _nf3(t)
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"))
    spend = t.orders.select(F.col("o_orderkey").alias("order_id"), amount("o_totalprice").alias("amount_spent"))
    return (denormalize(lines, [(headers.select("order_id", "priority_id"), "order_id", "inner"),
                                (priorities, "priority_id", "inner"), (spend, "order_id", "inner")])
            .select("order_id", "line_number", "priority", "amount_spent"))


def priority_report(t: Tables):
    """Reporting table: order, priority id and name, and amount in one place (O-DM5)."""
    priorities, headers, _ = _nf3(t)
    spend = t.orders.select(F.col("o_orderkey").alias("order_id"), amount("o_totalprice").alias("amount"))
    return denormalize(headers.select("order_id", "priority_id"),
                       [(priorities, "priority_id", "inner"), (spend, "order_id", "inner")])


@query("denorm_spend", """
SELECT o.o_orderkey AS transaction_id, c.c_name AS customer_name, CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount_spent
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def denorm_spend(t: Tables):
    """Reporting table: the measure folded next to the customer name (O-DM5)."""
    o, c = t.orders, t.customer
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("transaction_id"), F.col("c_name").alias("customer_name"),
                    amount("o_totalprice").alias("amount_spent")))


@query("cashier_sales", f"""
SELECT p.priority_id, p.priority, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total_sales
FROM orders JOIN ({_PRIORITIES_SQL}) p ON p.priority = o_orderpriority
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL""")
def cashier_sales(t: Tables):
    """Total sales per priority, read from the reporting table alone (O-A4, O-DM5)."""
    return priority_report(t).groupBy("priority_id", "priority").agg(
        F.sum("amount").cast("decimal(38,2)").alias("total_sales"))


@query("star_spend_over", """
SELECT c.c_name AS customer_name, o.o_orderkey AS order_id, n.n_name AS city, c.c_mktsegment AS segment,
       CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_totalprice > 100000""")
def star_spend_over(t: Tables):
    """Star query with a range filter on the measure (O-DM15, O-P6)."""
    o, c, n = t.orders, t.customer, t.nation
    return (o.filter(F.col("o_totalprice") > 100000)
            .join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_name").alias("customer_name"), F.col("o_orderkey").alias("order_id"),
                    F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment"),
                    amount("o_totalprice").alias("amount")))


# ------------------------------------------------- one dataset per query
_LIB = """WITH lib AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS priority,
       o_orderkey AS order_id, o_orderstatus AS status FROM orders)
"""
LIB_YEAR, LIB_PRIORITY, LIB_ORDER = 1997, "1-URGENT", 42


def order_library(t: Tables):
    return t.orders.select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority"),
                           F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))


def stored_library(t: Tables, partition_key, clustering, directories=True):
    """The dataset laid out for one access path, written once per state of
    ``orders``; every lookup of that path reads it."""
    return stored("library-" + "-".join([*partition_key, *clustering]), [t.orders], lambda: materialize_for_query(
        order_library(t), scratch_path(t.spark, "library"), partition_key, clustering, directories))


def _by_year(t: Tables):
    return stored_library(t, ["year"], ["priority", "order_id"])


_LIB_COLS = ("year", "priority", "order_id", "status")


@query("library_by_year", _LIB + f"SELECT * FROM lib WHERE year = {LIB_YEAR}")
def library_by_year(t: Tables):
    """Table keyed by year, clustered by priority and order (O-DM13, O-P12)."""
    return lookup(_by_year(t), year=LIB_YEAR).select(*_LIB_COLS)


@query("library_by_artist", _LIB + f"SELECT * FROM lib WHERE priority = '{LIB_PRIORITY}'")
def library_by_artist(t: Tables):
    """Table keyed by a low-cardinality name, clustered by year and order."""
    return lookup(stored_library(t, ["priority"], ["year", "order_id"]), priority=LIB_PRIORITY).select(*_LIB_COLS)


@query("library_by_album", _LIB + f"SELECT * FROM lib WHERE order_id = {LIB_ORDER}")
def library_by_album(t: Tables):
    """High-cardinality key: sorted file ranges, no directory per value."""
    return lookup(stored_library(t, ["order_id"], [], directories=False), order_id=LIB_ORDER).select(*_LIB_COLS)


@query("library_by_year_artist", _LIB + f"SELECT * FROM lib WHERE year = {LIB_YEAR} AND priority = '{LIB_PRIORITY}'")
def library_by_year_artist(t: Tables):
    """Partition key and the first clustering column."""
    return lookup(_by_year(t), year=LIB_YEAR, priority=LIB_PRIORITY).select(*_LIB_COLS)


@query("library_city_of_album", _LIB + f"""
SELECT arg_min(status, order_id) AS status FROM lib WHERE year = {LIB_YEAR} AND priority = '{LIB_PRIORITY}'""")
def library_city_of_album(t: Tables):
    """Full compound key (partition key + 2 clustering columns) -> one value."""
    lib = lookup(_by_year(t), year=LIB_YEAR, priority=LIB_PRIORITY)
    first = lib.agg(F.min("order_id").alias("order_id"))
    return lib.join(first, "order_id").select("status")


# ------------------------------------------------------------ keys and ids
_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
_LI_REST = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("upsert_latest", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY {', '.join(c + ' DESC' for c in _LI_ORDER + _LI_REST)}) = 1""")
def upsert_latest(t: Tables):
    """Last write wins per primary key (O-DM14)."""
    li = t.lineitem
    return upsert(li, ["l_orderkey", "l_linenumber"], _LI_ORDER).select(*li.columns)


_MERGED = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


@query("upsert_incremental", f"""
SELECT o_orderkey, o_custkey, if(o_orderkey % 50 = 0, 'X', o_orderstatus) AS o_orderstatus,
       if(o_orderkey % 50 = 0, 0.0, o_totalprice) AS o_totalprice, o_orderdate FROM orders""")
def upsert_incremental(t: Tables):
    """A keyed table takes a batch of changes, rewriting only the buckets that hold their keys (O-DM14): every tenth order
    is missing at first, then comes together with cancellations of every 50th order, each given twice, the later wins."""
    def build() -> KeyedTable:
        orders = t.orders.selectExpr(*_MERGED.split(", "))
        # some 128 MB of input a bucket
        buckets = sized_count(t.orders, target_bytes=128 << 20)
        table = KeyedTable(t.spark, scratch_path(t.spark, "orders-keyed"), ["o_orderkey"], buckets)
        table.merge(orders.where("o_orderkey % 10 <> 3"))
        cancelled = orders.where("o_orderkey % 50 = 0")
        price = lambda p: cancelled.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.lit(p)})
        late = orders.where("o_orderkey % 10 = 3").withColumn("_nth", F.lit(1))
        changes = late.unionByName(price(9.9).withColumn("_nth", F.lit(1))).unionByName(price(0.0).withColumn("_nth", F.lit(2)))
        table.merge(upsert(changes, ["o_orderkey"], ["_nth"]).drop("_nth"))
        return table

    return stored("orders-keyed", [t.orders], build).read().selectExpr(*_MERGED.split(", "))


@query("norm_3nf_nulls", """
SELECT if(o_orderkey % 7 = 0, NULL, o_orderpriority) AS priority, count(*) AS n FROM orders GROUP BY 1""")
def norm_3nf_nulls(t: Tables):
    """3NF on an attribute with NULLs: no row is lost, and the join back gives the values again (O-DM3, O-DM4)."""
    orders = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"))
    priorities, slim = extract_dimension(orders, "priority", "priority_id")
    return slim.join(priorities, "priority_id").groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


@query("surrogate_key", """
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS customer_key FROM customer""")
def surrogate_key(t: Tables):
    """SERIAL-style ids in name order without a one-partition window (O-DM6)."""
    c = t.customer.select("c_custkey", "c_name")
    return add_surrogate_key(c, ["c_name", "c_custkey"], "customer_key")


DAILY_REVENUE = T.StructType([
    T.StructField("revenue", T.DecimalType(38, 2), False),
    T.StructField("sale_date", T.DateType(), False),
])


def _daily_revenue(t: Tables):
    return (sales(t).groupBy(F.to_date("o_orderdate").alias("sale_date")).agg(F.sum("amt").alias("revenue")))


_DAILY_SQL = """SELECT CAST(sum(amt) AS DECIMAL(38,2)) AS revenue, CAST(o_orderdate AS DATE) AS sale_date
FROM sale GROUP BY CAST(o_orderdate AS DATE)"""


@query("insert_select", with_ctes(SALE) + _DAILY_SQL)
def insert_select(t: Tables):
    """``INSERT INTO t (cols) SELECT``: aligned by name, cast to the declared
    types, written to a parquet table, read back (O-K2)."""
    def build():
        path = scratch_path(t.spark, "daily_revenue")
        insert_into(_daily_revenue(t), DAILY_REVENUE, path, mode="append")
        return t.spark.read.schema(DAILY_REVENUE).parquet(path)

    return stored("daily-revenue", [t.lineitem, t.orders], build)


@query("insert_append", with_ctes(SALE) + f"{_DAILY_SQL} UNION ALL SELECT -revenue, sale_date FROM ({_DAILY_SQL})")
def insert_append(t: Tables):
    """A second INSERT into a table that already has rows: columns in another
    order are matched by name, earlier rows stay (O-K2, O-K3)."""
    def build():
        path = scratch_path(t.spark, "daily_ledger")
        insert_into(_daily_revenue(t), DAILY_REVENUE, path, mode="append")
        back = _daily_revenue(t).select((-F.col("revenue")).alias("revenue"), "sale_date")
        insert_into(back.select("sale_date", "revenue"), DAILY_REVENUE, path, mode="append")
        return t.spark.read.schema(DAILY_REVENUE).parquet(path)

    return stored("daily-ledger", [t.lineitem, t.orders], build)


@query("insert_batches", with_ctes(SALE) + f"""
SELECT *, if(sale_date < DATE '1995-01-01', 'to-1994', 'from-1995') AS batch FROM ({_DAILY_SQL})""")
def insert_batches(t: Tables):
    """INSERTs as named batches, each published once: a batch that is given a second time changes nothing (O-K2, O-K3)."""
    def build() -> str:
        path, daily = scratch_path(t.spark, "daily-batches"), _daily_revenue(t)
        early = F.col("sale_date") < "1995-01-01"
        append_batch(daily.where(early), DAILY_REVENUE, path, "to-1994")
        for _ in range(2):
            append_batch(daily.where(~early).select("sale_date", "revenue"), DAILY_REVENUE, path, "from-1995")
        return path

    path = stored("daily-batches", [t.lineitem, t.orders], build)
    return read_batches(t.spark, DAILY_REVENUE, path, names=True).withColumnRenamed("_batch", "batch")
