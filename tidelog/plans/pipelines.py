"""Composite pipelines (the user-level API of SURVEY §2.13).

Each returns DataFrames. Only what writes or iterates runs jobs while the plan
is built: ``resolve_identities``, ``text_to_parquet`` and ``preprocess_logs``
with a folder to store in.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import activity, geo, identity, keywords, logs, urls, versions, wordcount
from tidelog.session import stored
from tidelog.sources import readers, sinks


class Preprocessed(NamedTuple):
    records: DataFrame
    unmatched: DataFrame
    rejects: DataFrame


def preprocess_logs(
    lines: DataFrame,
    area_dic: DataFrame,
    biz_dic: DataFrame,
    stop_words: Iterable[str] | DataFrame | None = keywords.STOP_WORDS,
    col: str = "value",
    segmenter: keywords.Segmenter | None = None,
    store: str | None = None,
) -> Preprocessed:
    """Raw log lines -> enriched records with title keywords, the unmatched
    coordinates, and the rejected lines.

    ``stop_words`` may be a list or a DataFrame (``readers.read_stopwords``);
    ``segmenter`` splits titles into words. With ``store``, a folder, the lines
    are parsed once: parsed rows are written there and all three outputs read
    them. Without it each output is a plan of its own over the lines.
    """
    if store is None:
        parsed, rejects = logs.parse_logs(lines, col), logs.rejected_logs(lines, col)
    else:
        tagged = stored(logs.tagged_logs(lines, col), store)
        parsed = tagged.where("record is not null").select("record.*")
        rejects = tagged.where("record is null").select(F.col("line").alias(col))
    enriched = geo.enrich_location(logs.identity_filter(parsed), area_dic, biz_dic)
    with_keywords = keywords.add_title_keywords(enriched, stop_words, segmenter=segmenter)
    return Preprocessed(with_keywords, geo.unmatched_coordinates(enriched), rejects)


def build_area_dic(dump_lines: DataFrame, on_bad: str = "drop") -> DataFrame:
    """Area SQL dump lines -> (geohash5, province, city, district)."""
    return geo.build_area_dic(readers.parse_area_dump(dump_lines), on_bad)


def build_area_dic_from_locations(locations: DataFrame) -> DataFrame:
    """Location table (e.g. from ``readers.read_jdbc``) -> area dictionary."""
    return geo.area_dic_from_locations(locations)


def build_biz_dic(dump_lines: DataFrame) -> DataFrame:
    """Business-district dump lines -> (geohash6, province, city, district, biz)."""
    return geo.build_biz_dic(readers.parse_biz_dump(dump_lines))


def geocode_dic(responses: DataFrame, location_col: str = "location", response_col: str = "response") -> DataFrame:
    return geo.geocode_dictionary(responses, location_col, response_col)


def traffic_detail(records: DataFrame, url_dim: DataFrame, default: str = urls.DEFAULT_CATEGORY) -> DataFrame:
    return urls.traffic_detail(records, url_dim, default)


def activity_intervals(
    intervals: DataFrame, as_of: str | _dt.date, per_user: bool = False, user_col: str = "user"
) -> DataFrame:
    return activity.interval_histogram(intervals, as_of, per_user=per_user, user_col=user_col)


def version_upgrades(installs: DataFrame, version_order: str = "lexical") -> DataFrame:
    return versions.version_upgrades(installs, version_order=version_order)


def resolve_identities(rows: DataFrame, id_cols: Iterable[str], typed: bool = False) -> identity.Components:
    return identity.resolve_identities(rows, list(id_cols), typed=typed)


def word_count(lines: DataFrame, sep: str = ",", top: int | None = None, col: str = "value") -> DataFrame:
    return wordcount.word_count(lines, col, sep, top)


def text_to_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str, out: str, sep: str = ",", mode: str = "errorifexists"
) -> DataFrame:
    """Delimited text -> typed parquet; returns the read-back DataFrame."""
    sinks.write_parquet(readers.read_delimited(spark, path, schema, sep), out, mode=mode)
    return readers.read_parquet(spark, out)
