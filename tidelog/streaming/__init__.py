"""Incremental runs of the log pipeline (Structured Streaming)."""

from tidelog.streaming.logs import (
    preprocess_log_stream,
    read_log_stream,
    start_parquet_sink,
    start_traffic_detail,
)

__all__ = ["preprocess_log_stream", "read_log_stream", "start_parquet_sink", "start_traffic_detail"]
