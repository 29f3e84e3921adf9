"""Scalar expressions (O-F*) and SQL function registration (O-U4)."""

from .dates import date_key, date_parts, epoch_ms, hour_of_epoch_ms, is_weekend
from .logs import (ACCESS_LOG_FIELDS, ACCESS_LOG_PATTERN, ACCESS_LOG_PATTERN_LENIENT, access_log_fields,
                   access_log_map, access_log_parts, date_time_parts, fields_from_parts, log_timestamp,
                   map_from_parts, matches_access_log)
from .sqlfuncs import register_functions

__all__ = [
    "date_key", "date_parts", "epoch_ms", "hour_of_epoch_ms", "is_weekend", "ACCESS_LOG_FIELDS",
    "ACCESS_LOG_PATTERN", "ACCESS_LOG_PATTERN_LENIENT", "access_log_fields", "access_log_map", "access_log_parts", "fields_from_parts", "map_from_parts",
    "date_time_parts", "log_timestamp", "matches_access_log", "register_functions",
]
