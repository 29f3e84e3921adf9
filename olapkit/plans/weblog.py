"""Access-log keys over lines derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.logs import ACCESS_LOG_FIELDS
from ..operators.weblog import (access_log_lines, map_fields, parse_access_log, parsed_map, top_counts,
                                with_typed_size, with_typed_time)
from ..session import scratch_path
from ..sources.readers import Tables, read_log_lines
from ..sources.stored import stored
from .registry import query

# The oracles know what each line was made from: its fields come from the
# event, not from a pattern. An error line has the size '-', which the strict
# pattern refuses.
_LOG = """WITH log AS (SELECT event_type = 'error' AS refused, format('u{}.example.net', user_id) AS host,
  '-' AS client_identd, '-' AS user_id, strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' AS date_time, 'GET' AS method,
  format('/{}/{}', event_type, event_id % 50) AS endpoint, 'HTTP/1.0' AS protocol,
  if(event_type = 'error', '500', '200') AS response_code,
  if(event_type = 'error', '-', CAST(event_id % 9973 AS VARCHAR)) AS content_size, ts FROM events),
parsed AS (SELECT * EXCLUDE (refused, ts) FROM log WHERE NOT refused)
"""


def log_lines(t: Tables):
    """The access log as gz text files, written once per state of ``events`` and scanned by every job (O-S2)."""
    def build():
        path = scratch_path(t.spark, "access-log")
        access_log_lines(t.events).write.option("compression", "gzip").text(path)
        return read_log_lines(t.spark, path)

    return stored("access-log", [t.events], build)


def _parsed(t: Tables):
    return parse_access_log(log_lines(t)).parsed


@query("log_parse", _LOG + "FROM parsed")
def log_parse(t: Tables):
    """Lines -> nine named fields with the strict pattern (O-LG1, O-F8)."""
    return _parsed(t)


@query("log_rejects", _LOG + """SELECT format('{} - - [{}] "GET {} HTTP/1.0" 500 -', host, date_time, endpoint) AS value
FROM log WHERE refused""")
def log_rejects(t: Tables):
    """Lines the strict pattern does not take (kept, not lost)."""
    return parse_access_log(log_lines(t)).rejected


@query("log_parse_lenient", _LOG + """
SELECT * EXCLUDE (refused, ts) REPLACE (if(refused, '0', content_size) AS content_size) FROM log""")
def log_parse_lenient(t: Tables):
    """Lenient pattern: a '-' size parses as 0 (O-F12)."""
    return parse_access_log(log_lines(t), lenient=True).parsed


@query("log_map_fields", _LOG + "SELECT " + ", ".join(
    f"if(refused, NULL, {f}) AS {f}" for f in ACCESS_LOG_FIELDS) + " FROM log")
def log_map_fields(t: Tables):
    """Map column ``parsed`` and every field out of it by name (O-F10, O-U3)."""
    return map_fields(parsed_map(log_lines(t)), ACCESS_LOG_FIELDS)


@query("log_timestamp", _LOG + """
SELECT * EXCLUDE (refused, ts), strftime(ts, '%d/%b/%Y') AS date, strftime(ts, '%H:%M:%S') AS time,
       date_trunc('second', ts) + INTERVAL 4 HOUR AS event_time FROM log WHERE NOT refused""")
def log_timestamp(t: Tables):
    """Date and time split out of the log time, plus the typed instant (O-F9)."""
    return with_typed_time(_parsed(t))


@query("popular_hosts", _LOG + "SELECT host, count(*) AS count FROM parsed GROUP BY host "
       "ORDER BY count DESC, host LIMIT 15")
def popular_hosts(t: Tables):
    """Top 15 hosts (O-LG2)."""
    return top_counts(_parsed(t), "host", 15)


@query("popular_content", _LOG + "SELECT endpoint, count(*) AS count FROM parsed GROUP BY endpoint "
       "ORDER BY count DESC, endpoint LIMIT 10")
def popular_content(t: Tables):
    """Top 10 endpoints (O-LG3)."""
    return top_counts(_parsed(t), "endpoint", 10)


@query("large_files_text", _LOG + "SELECT endpoint, content_size FROM parsed "
       "ORDER BY content_size DESC, endpoint LIMIT 10")
def large_files_text(t: Tables):
    """Top sizes sorted as text: '999' before '9972' (the untyped-sort trap, O-L5)."""
    return (_parsed(t).select("endpoint", "content_size")
            .orderBy(F.desc("content_size"), "endpoint").limit(10))


@query("large_files", _LOG + "SELECT endpoint, TRY_CAST(content_size AS INTEGER) AS content_size_int "
       "FROM parsed ORDER BY content_size_int DESC, endpoint LIMIT 10")
def large_files(t: Tables):
    """Top sizes after the numeric cast (O-LG4, O-F7)."""
    return (with_typed_size(_parsed(t)).select("endpoint", "content_size_int")
            .orderBy(F.desc("content_size_int"), "endpoint").limit(10))
