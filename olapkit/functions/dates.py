"""Date and time expressions, all native (codegen'd) Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts) -> Column:
    """Integer ``yyyyMMdd`` key of a date or timestamp.

    Computed arithmetically; the text route needs the pattern ``yyyyMMdd``
    (``DD`` would be the day of the year).
    """
    ts = _c(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def is_weekend(ts) -> Column:
    """ISO day of week 6 or 7 (Saturday, Sunday)."""
    return F.dayofweek(_c(ts)).isin(1, 7)


def date_parts(ts) -> list[Column]:
    """The calendar columns of a date dimension (ISO week)."""
    ts = _c(ts)
    return [
        date_key(ts).alias("date_key"),
        F.to_date(ts).alias("date"),
        F.year(ts).cast("smallint").alias("year"),
        F.quarter(ts).cast("smallint").alias("quarter"),
        F.month(ts).cast("smallint").alias("month"),
        F.dayofmonth(ts).cast("smallint").alias("day"),
        F.weekofyear(ts).cast("smallint").alias("week"),
        is_weekend(ts).alias("is_weekend"),
    ]


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a timestamp (NTZ read as UTC)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def hour_of_epoch_ms(ms) -> Column:
    """Hour of day of an epoch-millisecond value, in the session time zone."""
    return F.hour(F.timestamp_millis(_c(ms)))
