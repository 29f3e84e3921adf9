"""Schema-on-read access-log job (O-LG1..O-LG4, O-F8..O-F10, O-F12).

Lines are parsed with native regex expressions, so parsing runs
inside whole-stage codegen with no Python worker; a line that does not match
goes to the ``rejected`` output instead of being dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logs import (access_log_parts, date_time_parts, fields_from_parts, log_timestamp, map_from_parts,
                              matches_access_log, split_access_log)


def access_log_lines(events: DataFrame) -> DataFrame:
    """Common-log-format lines derived from events (one ``value`` column).

    ``error`` events get status 500 and size ``-`` (rejected by the strict
    pattern); the time text is the event time written with a -0400 zone.
    """
    is_err = F.col("event_type") == "error"
    status = F.when(is_err, F.lit("500")).otherwise(F.lit("200"))
    size = F.when(is_err, F.lit("-")).otherwise((F.col("event_id") % 9973).cast("string"))
    return events.select(F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
        F.col("event_type"), F.lit("/"), (F.col("event_id") % 50).cast("string"),
        F.lit(' HTTP/1.0" '), status, F.lit(" "), size,
    ).alias("value"))


@dataclass
class ParsedLog:
    parsed: DataFrame
    rejected: DataFrame


def parse_access_log(lines: DataFrame, lenient: bool = False, value: str = "value") -> ParsedLog:
    """Split lines into parsed rows (nine string fields) and rejected lines.

    The pattern is matched once to choose the lines and once to cut them;
    the fields are read from the array of groups.
    """
    v = F.col(value)
    ok = F.coalesce(matches_access_log(v, lenient), F.lit(False))
    parts = lines.filter(ok).select(split_access_log(v, lenient).alias("_parts"))
    parsed = parts.select(*[c.alias(n) for n, c in fields_from_parts(F.col("_parts"), lenient).items()])
    return ParsedLog(parsed, lines.filter(~ok))


def parsed_map(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with a ``parsed`` map column (NULL for non-matching lines)."""
    return (lines.withColumn("_parts", access_log_parts(F.col(value)))
            .withColumn("parsed", map_from_parts(F.col("_parts"))).drop("_parts"))


def map_fields(df: DataFrame, fields, col: str = "parsed") -> DataFrame:
    """Explode map keys into columns (``parsed['host'] AS host`` ...)."""
    return df.selectExpr(*[f"{col}['{f}'] AS {f}" for f in fields])


def with_typed_time(parsed: DataFrame) -> DataFrame:
    """Date text, time text and the typed timestamp of each parsed row."""
    dt = F.col("date_time")
    return parsed.select("*", *date_time_parts(dt), log_timestamp(dt).alias("event_time"))


def bad_times(parsed: DataFrame) -> DataFrame:
    """Parsed rows whose time text is no date (their typed time is NULL)."""
    return parsed.where(log_timestamp(F.col("date_time")).isNull())


def with_typed_size(parsed: DataFrame) -> DataFrame:
    """Numeric size; ``try_cast`` turns text that is not a number into NULL."""
    return parsed.withColumn("content_size_int", F.col("content_size").try_cast("int"))


def top_counts(df: DataFrame, key: str, n: int) -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(n))
