"""Access-log (common log format) parsing with native regex expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's for equal results) ----------
# Strict line pattern: host, identd, user, [date zone], "method endpoint
# protocol", status, size. The zone must start with '-' and the size must be
# digits.
ACCESS_LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[(\S+) (\-[\d]+)\] "([A-Za-z]+) (\S+) (\S+)" ([0-9]+) (\d+)'
)
# Field names of a parsed line, in order.
ACCESS_LOG_FIELDS = [
    "host", "client_identd", "user_id", "date_time", "method", "endpoint",
    "protocol", "response_code", "content_size",
]
# Date/time split of "01/Jul/1995:00:00:01 -0400": date part, time part.
DATE_TIME_SPLIT_PATTERN = r"^([0-9A-Za-z\/]+)\:(\d+\:\d+\:\d+) \-"
# Timestamp format of the date_time field.
ACCESS_LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# -----------------------------------------------------------------------------

# Lenient variant (own addition): a '-' size is accepted and read as 0.
ACCESS_LOG_PATTERN_LENIENT = ACCESS_LOG_PATTERN[: -len(r"(\d+)")] + r"(\d+|-)"


def _pattern(lenient: bool) -> str:
    return ACCESS_LOG_PATTERN_LENIENT if lenient else ACCESS_LOG_PATTERN


def split_access_log(value: Column, lenient: bool = False) -> Column:
    """The ten capture groups of a matching line as one array, by one regex
    match: the line is rewritten into its groups with a blank between them
    and cut there. No group of the pattern can hold a blank, and ``(?s)``
    takes the whole rest of the line away, also behind a line break."""
    groups = " ".join(f"${i}" for i in range(1, 11))
    return F.split(F.regexp_replace(value, "(?s)" + _pattern(lenient) + ".*", groups), " ")


def access_log_parts(value: Column, lenient: bool = False) -> Column:
    """The ten capture groups of a line, NULL when it does not match: one
    ``rlike`` and one ``regexp_replace``. Keep the array in its own column
    when several fields are read from it."""
    return F.when(value.rlike(_pattern(lenient)), split_access_log(value, lenient))


def fields_from_parts(parts: Column, lenient: bool = False) -> dict[str, Column]:
    """Named fields out of the group array (NULL for a non-matching line)."""
    g = [F.try_element_at(parts, F.lit(i)) for i in range(1, 11)]
    size = g[9]
    if lenient:
        size = F.when(size == "-", F.lit("0")).otherwise(size)
    return {
        "host": g[0],
        "client_identd": g[1],
        "user_id": g[2],
        "date_time": F.when(parts.isNotNull(), F.concat_ws(" ", g[3], g[4])),
        "method": g[5],
        "endpoint": g[6],
        "protocol": g[7],
        "response_code": g[8],
        "content_size": size,
    }


def access_log_fields(value: Column, lenient: bool = False) -> list[Column]:
    """The nine named fields of a line (strings; NULL where it does not match)."""
    return [c.alias(n) for n, c in fields_from_parts(access_log_parts(value, lenient), lenient).items()]


def matches_access_log(value: Column, lenient: bool = False) -> Column:
    return value.rlike(_pattern(lenient))


def map_from_parts(parts: Column, lenient: bool = False) -> Column:
    """``map<string,string>`` of the named fields (NULL for a non-matching line)."""
    kv = []
    for name, c in fields_from_parts(parts, lenient).items():
        kv.extend([F.lit(name), c])
    return F.when(parts.isNotNull(), F.create_map(*kv))


def access_log_map(value: Column, lenient: bool = False) -> Column:
    """Parsed line as ``map<string,string>`` (NULL when the line does not match)."""
    return map_from_parts(access_log_parts(value, lenient), lenient)


def date_time_parts(date_time: Column) -> list[Column]:
    """Date and time text out of the log's date_time field."""
    return [
        F.regexp_extract(date_time, DATE_TIME_SPLIT_PATTERN, 1).alias("date"),
        F.regexp_extract(date_time, DATE_TIME_SPLIT_PATTERN, 2).alias("time"),
    ]


def log_timestamp(date_time: Column) -> Column:
    """Typed instant of the date_time field, as UTC wall-clock (NTZ); NULL marks a time that is no date."""
    return F.try_to_timestamp(date_time, F.lit(ACCESS_LOG_TIME_FORMAT)).cast("timestamp_ntz")
