"""Registered jobs (one per SURVEY §2 key) and their DuckDB oracle SQL."""

from . import eventlog, files, history, modeling, quality, ssb, warehouse, weblog  # noqa: F401
from .registry import ORACLE, QUERIES, query


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)


__all__ = ["ORACLE", "QUERIES", "query", "queries", "oracle_sql"]
