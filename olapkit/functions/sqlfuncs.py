"""SQL-callable functions.

Registered as SQL-bodied temporary functions: Catalyst inlines the body, so
a call stays a native expression inside whole-stage codegen instead of a
Python worker round trip.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "get_hour": "CREATE OR REPLACE TEMPORARY FUNCTION get_hour(ts BIGINT) RETURNS INT "
                "RETURN hour(timestamp_millis(ts))",
    "is_flag": "CREATE OR REPLACE TEMPORARY FUNCTION is_flag(value STRING, flag STRING) RETURNS INT "
               "RETURN CASE WHEN value = flag THEN 1 ELSE 0 END",
}


def register_functions(spark: SparkSession) -> list[str]:
    for stmt in SQL_FUNCTIONS.values():
        spark.sql(stmt)
    return list(SQL_FUNCTIONS)
