"""URL categories (J4 longest-prefix lookup, A9) and the traffic detail table (C4).

Longest prefix match without a nested-loop join and without a row for each length a
URL may be cut at:

1. the dimension is reduced to one category per prefix (A9);
2. the distinct URLs of the facts are taken (a partial-aggregated shuffle of
   one column: a URL that makes up a third of all rows costs one row per task);
3. URLs and prefixes are sorted together over range partitions. In that order a
   prefix comes right before all that begins with it, so one pass with a stack of
   open prefixes finds each URL's longest one: rows made are URLs plus prefixes;
4. a prefix may be open from an earlier partition on. A URL that found none in its
   own has, from earlier ones, just those prefixes that the first key of its
   partition has too. Such stacks are looked up once per partition, not per URL;
5. the URLs that matched join back to the facts by ``lookup_join``, which deals
   a hot URL's rows over several tasks; unmatched URLs get the default.

The result equals ``startsWith`` over all prefixes keeping the longest match.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.dates import millis_to_day
from tidelog.operators.joins import MAX_BROADCAST_BYTES, lookup_join, sized_broadcast

# Fixed value: the category of a URL no prefix matches ("other").
DEFAULT_CATEGORY = "其他"

# The columns of a detail row, in order.
DWD_COLUMNS = (
    "cookieid", "account", "imei", "osName", "osVer", "resolution", "androidId", "manufacture", "deviceId",
    "appid", "appVer", "release_ch", "promotion_ch", "areacode", "longtitude", "latitude", "carrier", "netType",
    "sessionId", "eventType", "commit_time", "province", "city", "district", "biz", "ct", "dateStr",
)


def url_dimension(dim: DataFrame, prefix: str = "prefix", category: str = "category") -> DataFrame:
    """A9: one category per prefix (the smallest), blank prefixes dropped."""
    return (
        dim.where(F.col(prefix).isNotNull() & (F.length(prefix) > 0))
        .groupBy(F.col(prefix).alias("prefix"))
        .agg(F.min(category).alias("category"))
    )


def _distinct_urls(urls: DataFrame, url_col: str) -> DataFrame:
    return urls.select(F.col(url_col).alias("_url")).where(F.col("_url").isNotNull()).distinct()


def _open_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, is_url, category) in order -> (_url, _ct, _cut) for every URL: the
    category of its longest prefix in this partition, or, if there is none, what the
    URL shares with the partition's first key."""
    first, stack = None, []
    for batch in batches:
        urls, categories, cuts = [], [], []
        for key, is_url, category in zip(*(c.to_pylist() for c in batch.columns)):
            first = key if first is None else first
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                stack.append((key, category))
                continue
            urls.append(key)
            categories.append(stack[-1][1] if stack else None)
            cuts.append(None if stack else os.path.commonprefix([first, key]))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (urls, categories, cuts)], names=["_url", "_ct", "_cut"])


def _best_hits(distinct_urls: DataFrame, dim: DataFrame, max_bytes: int) -> DataFrame:
    """(_url, _ct) for the URLs that match some prefix (longest prefix wins)."""
    # A category that is null is kept apart from no match at all.
    d = url_dimension(dim).where(F.col("category").isNotNull())
    keys = distinct_urls.select(F.col("_url").alias("key"), F.lit(True).alias("is_url"), F.lit(None).cast("string").alias("category"))
    both = keys.unionByName(d.select(F.col("prefix").alias("key"), F.lit(False).alias("is_url"), "category"))
    found = both.repartitionByRange("key", "is_url").sortWithinPartitions("key", "is_url").mapInArrow(_open_prefixes, "_url string, _ct string, _cut string")
    # The cuts of a partition are beginnings of its first key: few, whatever the URLs.
    cuts = found.where("_ct is null and length(_cut) > 0").select("_cut").distinct()
    starts = cuts.select("_cut", F.explode(F.sequence(F.lit(1), F.length("_cut"))).alias("_len")).withColumn("prefix", F.substr("_cut", F.lit(1), F.col("_len")))
    carried = starts.join(sized_broadcast(d, max_bytes), "prefix").groupBy("_cut").agg(F.max_by("category", "_len").alias("_ct"))
    own = found.where("_ct is not null").select("_url", "_ct")
    return own.unionByName(found.where("_ct is null").select("_url", "_cut").join(carried, "_cut").select("_url", "_ct"))


def url_categories(
    urls: DataFrame, dim: DataFrame, url_col: str = "url", default: str = DEFAULT_CATEGORY, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Distinct URLs of ``urls`` -> (url, ct) with the longest matching prefix."""
    distinct_urls = _distinct_urls(urls, url_col)
    best = _best_hits(distinct_urls, dim, max_bytes)
    return distinct_urls.join(best, "_url", "left").select(F.col("_url").alias(url_col), F.coalesce("_ct", F.lit(default)).alias("ct"))


def categorize(
    facts: DataFrame, dim: DataFrame, url: str = "url", default: str = DEFAULT_CATEGORY, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Facts + ``ct`` column (longest matching prefix's category, else default)."""
    best = _best_hits(_distinct_urls(facts, url), dim, max_bytes).withColumnRenamed("_url", url)
    joined = lookup_join(facts, best, url, max_bytes)
    return joined.select(*[F.col(c) for c in facts.columns], F.coalesce("_ct", F.lit(default)).alias("ct"))


def page_views(records: DataFrame) -> DataFrame:
    """P6: the ``pg_view`` records with a URL; the type is named ``eventType``."""
    views = records.withColumnRenamed("logType", "eventType") if "logType" in records.columns else records
    return views.where((F.col("eventType") == "pg_view") & F.try_element_at("event", F.lit("url")).isNotNull())


def traffic_detail(
    records: DataFrame,
    url_dim: DataFrame,
    default: str = DEFAULT_CATEGORY,
    time_zone: str | None = "UTC",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Pre-processed records -> page-view detail rows (27 columns).

    Keeps ``pg_view`` rows with a URL (P6), adds the URL category (J4) and the
    day (F3), drops the event map (P15) and names the type ``eventType``.
    """
    views = page_views(records).withColumn("_url", F.try_element_at("event", F.lit("url"))).drop("event")
    tagged = categorize(views, url_dim, "_url", default, max_bytes)
    return tagged.withColumn("dateStr", millis_to_day("commit_time", time_zone)).select(*DWD_COLUMNS)
