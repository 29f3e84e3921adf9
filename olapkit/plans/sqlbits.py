"""Shared DuckDB SQL pieces for the oracle statements (CTEs over the test
tables that mirror the Spark builders)."""

from __future__ import annotations

DATE_KEY = "CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"

SALE = """sale AS (
  SELECT l.*, o.*, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

FACT = f"""fact AS (
  SELECT {DATE_KEY.format(c='o.o_orderdate')} AS date_key,
         o.o_custkey AS customer_key, l.l_partkey AS item_key, l.l_suppkey AS store_key,
         l.l_orderkey AS order_key, l.l_linenumber AS line_number,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS sales_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

DIM_DATE = f"""dim_date AS (
  SELECT {DATE_KEY.format(c='d')} AS date_key, d AS date,
         CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
         CAST(month(d) AS SMALLINT) AS month, CAST(day(d) AS SMALLINT) AS day,
         CAST(week(d) AS SMALLINT) AS week, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) days)"""

DIM_CUSTOMER = """dim_customer AS (
  SELECT c.c_custkey AS customer_key, c.c_custkey AS customer_id, c.c_name AS name,
         c.c_mktsegment AS district, n.n_name AS city, r.r_name AS country, c.c_acctbal AS acctbal,
         TIMESTAMP '2024-01-01 00:00:00' AS start_date, TIMESTAMP '2024-01-01 00:00:00' AS end_date
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

DIM_ITEM = """dim_item AS (
  SELECT p_partkey AS item_key, p_partkey AS item_id, p_name AS title, p_type AS rating,
         p_brand AS brand, p_size AS size, p_retailprice AS retail_price,
         (SELECT n_name FROM nation WHERE n_nationkey = p_partkey % 25) AS made_in,
         (SELECT n_name FROM nation WHERE n_nationkey = p_size) AS designed_in
  FROM part)"""

DIM_STORE = """dim_store AS (
  SELECT s.s_suppkey AS store_key, s.s_suppkey AS store_id, s.s_name AS manager_name,
         n.n_name AS city, r.r_name AS country,
         TIMESTAMP '2024-01-01 00:00:00' AS start_date, TIMESTAMP '2024-01-01 00:00:00' AS end_date
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

STAR = ",\n".join([FACT, DIM_DATE, DIM_CUSTOMER, DIM_ITEM, DIM_STORE])


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
