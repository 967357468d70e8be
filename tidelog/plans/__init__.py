"""User-level pipelines (``tidelog.plans.pipelines``); the driver-table
bindings live in ``bindings``/``derive``/``oracles`` and are imported explicitly."""

from tidelog.plans.pipelines import (
    Preprocessed,
    activity_intervals,
    build_area_dic,
    build_area_dic_from_locations,
    build_biz_dic,
    geocode_dic,
    preprocess_logs,
    resolve_identities,
    text_to_parquet,
    traffic_detail,
    version_upgrades,
    word_count,
)

__all__ = [
    "Preprocessed",
    "activity_intervals",
    "build_area_dic",
    "build_area_dic_from_locations",
    "build_biz_dic",
    "geocode_dic",
    "preprocess_logs",
    "resolve_identities",
    "text_to_parquet",
    "traffic_detail",
    "version_upgrades",
    "word_count",
]
