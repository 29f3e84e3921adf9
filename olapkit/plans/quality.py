"""Data-quality keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import ForeignKey, fk_orphans, load_counts, load_diff, not_null_report, pk_duplicates
from ..sources.readers import Tables
from .registry import query

# relation name, child table, fk, parent table, pk. Orphans are made on the
# whole tables: every 97th key of the marked relations is moved out of range.
_RELATIONS = [
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey", True),
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey", False),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey", True),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey", False),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey", False),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey", False),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey", False),
]

_FK_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS relation, count(*) FILTER (WHERE k NOT IN (SELECT {pk} FROM {parent})) AS orphans "
    f"FROM (SELECT {f'if({fk} % 97 = 0, -{fk} - 1, {fk})' if moved else fk} AS k FROM {child})"
    for name, child, fk, parent, pk, moved in _RELATIONS)


@query("fk_orphans", _FK_SQL)
def fk_orphans_q(t: Tables):
    """REFERENCES check: orphan rows per relation (O-DQ2)."""
    rels = []
    for name, child, fk, parent, pk, moved in _RELATIONS:
        df, key = t.get(child), F.col(fk)
        if moved:
            df = df.withColumn(fk, F.when(key % 97 == 0, -key - 1).otherwise(key))
        rels.append(ForeignKey(name, df, fk, t.get(parent), pk))
    return fk_orphans(rels)


@query("pk_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_duplicates_q(t: Tables):
    """PRIMARY KEY check: keys held by more than one row (O-DQ3)."""
    return pk_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


_ORDERS_COLS = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", True), ("o_totalprice", False),
                ("o_orderdate", False), ("o_orderpriority", True)]


@query("not_null_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    + (f"CAST(max(length({c})) AS INTEGER)" if s else "CAST(NULL AS INTEGER)") + " AS max_length FROM orders"
    for c, s in _ORDERS_COLS))
def not_null_report_q(t: Tables):
    """NOT NULL and length check of every column in one pass (O-DQ4)."""
    return not_null_report(t.orders)


# A second load of ``orders`` in which every 89th order came twice, and every
# 97th with another price.
_SECOND_SQL = """(SELECT * REPLACE (if(o_orderkey % 97 = 0, o_totalprice + 1, o_totalprice) AS o_totalprice) FROM orders
  UNION ALL SELECT * FROM orders WHERE o_orderkey % 89 = 0)"""


def _second_load(t: Tables):
    price = F.col("o_totalprice")
    changed = t.orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 97 == 0, price + 1).otherwise(price))
    return changed.unionByName(t.orders.where("o_orderkey % 89 = 0"))


@query("load_counts", f"""
SELECT *, first_count - second_count AS difference
FROM (SELECT count(*) AS first_count FROM orders), (SELECT count(*) AS second_count FROM {_SECOND_SQL})""")
def load_counts_q(t: Tables):
    """Row counts of two loads (O-DQ5)."""
    return load_counts(t.orders, _second_load(t))


@query("load_diff", f"""
(SELECT *, 'second' AS missing_from FROM orders EXCEPT ALL SELECT *, 'second' FROM {_SECOND_SQL})
UNION ALL (SELECT *, 'first' FROM {_SECOND_SQL} EXCEPT ALL SELECT *, 'first' FROM orders)""")
def load_diff_q(t: Tables):
    """The rows one load misses (O-DQ5)."""
    return load_diff(t.orders, _second_load(t))
