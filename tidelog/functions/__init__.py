"""Column expressions (JVM-side, codegen-friendly)."""

from tidelog.functions.dates import (
    OPEN_END,
    close_open_interval,
    day_diff,
    millis_to_day,
    parse_day,
)
from tidelog.functions.geo import GEOHASH_ALPHABET, geohash, geohash_sql
from tidelog.functions.text import (
    WORD_SEPARATOR,
    any_identifier,
    interval_label,
    is_blank,
    is_not_blank,
    map_put,
    non_blank_array,
    tokens,
)

__all__ = [
    "GEOHASH_ALPHABET",
    "OPEN_END",
    "WORD_SEPARATOR",
    "any_identifier",
    "close_open_interval",
    "day_diff",
    "geohash",
    "geohash_sql",
    "interval_label",
    "is_blank",
    "is_not_blank",
    "map_put",
    "millis_to_day",
    "non_blank_array",
    "parse_day",
    "tokens",
]
