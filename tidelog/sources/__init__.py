"""Readers and writers."""

from tidelog.sources.readers import (
    parse_area_dump,
    parse_biz_dump,
    parse_delimited,
    read_csv,
    read_delimited,
    read_jdbc,
    read_lines,
    read_parquet,
    read_stopwords,
    read_url_dimension,
)
from tidelog.sources.sinks import write_dictionary, write_lines, write_parquet

__all__ = [
    "parse_area_dump",
    "parse_biz_dump",
    "parse_delimited",
    "read_csv",
    "read_delimited",
    "read_jdbc",
    "read_lines",
    "read_parquet",
    "read_stopwords",
    "read_url_dimension",
    "write_dictionary",
    "write_lines",
    "write_parquet",
]
