"""Registered queries: each operator bound to the driver's tables.

The driver's tables carry no logs, coordinates or version strings, so each
query derives its operator's input from whole tables with plain column
arithmetic, and the matching oracle in ``tidelog.plans.oracles`` repeats that
derivation in SQL. Every query reads complete tables; nothing is sampled,
filtered by id, or capped except where a limit is the feature (top-k).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.geo import geohash
from tidelog.operators import activity, geo, identity, keywords, lattice, logs, urls, versions, wordcount
from tidelog.plans import derive
from tidelog.plans.pipelines import preprocess_logs
from tidelog.plans.tables import table
from tidelog.session import scratch_path, stored
from tidelog.sources import readers, sinks

# Parameters shared with the oracles (fixed by the bindings, not by the data).
AS_OF = "2024-01-31"
WHITESPACE = r"[ \t\n\r]+"
# The dictionary of the segmenter's query, shared with its oracle.
SYLLABLES = ("tion", "ing", "the", "that", "ble", "and", "heit", "keit", "lich", "ment", "elle", "ción", "mente")

Query = Callable[[SparkSession, str], DataFrame]


# --- activity intervals (C5) -------------------------------------------------


def _zipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = activity.activity_runs(table(spark, sf_dir, "events"), "user_id", "ts")
    return activity.zipper_table(runs, AS_OF, "user_id")


def activity_zipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zipper(spark, sf_dir)


# Days that the incremental query adds one by one to the table of the days before.
DAILY_FROM = "2024-01-26"


def activity_zipper_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval table of the days before, then day by day what each one changes:
    open intervals go on, end or begin; ended ones are only ever appended."""
    events = table(spark, sf_dir, "events")
    day, last = dt.date.fromisoformat(DAILY_FROM), dt.date.fromisoformat(AS_OF)
    base = _scratch(spark, "intervals")
    before = events.where(F.to_date("ts") < F.lit(day))
    start = stored(activity.zipper_table(activity.activity_runs(before, "user_id", "ts"), day, "user_id"), f"{base}/start")
    open_rows, closed, users = activity.open_part(start), [activity.closed_part(start)], [activity.known_users(start)]
    while day < last:
        known = reduce(DataFrame.unionByName, users)
        step = activity.advance_day(open_rows, known, events, day)
        open_rows = stored(step.open, f"{base}/{day}-open")
        closed.append(stored(step.closed, f"{base}/{day}-closed"))
        users.append(stored(step.new_users, f"{base}/{day}-users"))
        day += dt.timedelta(days=1)
    return activity.assembled(open_rows, reduce(DataFrame.unionByName, closed))


def open_interval_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.close_intervals(_zipper(spark, sf_dir), AS_OF, user_col="user_id")


def activity_intervals_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.interval_histogram(_zipper(spark, sf_dir), AS_OF, per_user=False, user_col="user_id")


def activity_intervals_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.interval_histogram(_zipper(spark, sf_dir), AS_OF, per_user=True, user_col="user_id")


def _to_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write ``df`` as header CSV (all text) in the shared checkpoint folder."""
    path = _scratch(spark, name)
    df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("header", True).csv(path)
    return path


def activity_intervals_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original job's path: the interval table as a header CSV of text
    columns (open end 9999-12-31) -> per-user histogram."""
    z = _zipper(spark, sf_dir).withColumnRenamed("user_id", "user")
    intervals = readers.read_csv(spark, _to_csv(spark, z, "intervals-csv"))
    return activity.interval_histogram(intervals, AS_OF, per_user=True, user_col="user")


# --- version upgrades (C6) ---------------------------------------------------


def _installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("app_name"),
        F.to_date("o_orderdate").alias("app_date"),
        F.col("o_orderpriority").alias("app_ver"),
    )


def version_upgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_upgrades(_installs(spark, sf_dir))


def version_upgrades_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original job's path: installs as a header CSV of text columns."""
    return versions.version_upgrades(readers.read_csv(spark, _to_csv(spark, _installs(spark, sf_dir), "installs-csv")))


# --- word count (C8) ---------------------------------------------------------


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wordcount.word_count(docs, "text", WHITESPACE, order="word")


def word_count_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wordcount.word_count(docs, "text", WHITESPACE, top=10, order="count")


def word_count_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wordcount.word_count(docs, "text", WHITESPACE, top=10, order="word")


# --- access logs (C1) -------------------------------------------------------

def _flat(records: DataFrame) -> DataFrame:
    """The records with their whole event map as text, one key=value a line, sorted."""
    keep = [c for c in records.columns if c not in ("event", *geo.GEO_COLUMNS)]
    given = F.filter(F.map_entries("event"), lambda e: e["value"].isNotNull())
    lines = F.array_sort(F.transform(given, lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return records.select(*keep, F.array_join(lines, "\n").alias("event"))


def log_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(logs.parse_logs(derive.log_lines(spark, sf_dir)))


def log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.rejected_logs(derive.log_lines(spark, sf_dir)).select(F.col("value").alias("line"))


def identity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = logs.identity_filter(logs.parse_logs(derive.log_lines(spark, sf_dir)))
    return kept.select("commit_time", *logs.IDENTITY_COLUMNS)


def _area_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.build_area_dic(readers.parse_area_dump(derive.area_dump_lines(spark, sf_dir)))


def _biz_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.build_biz_dic(readers.parse_biz_dump(derive.biz_dump_lines(spark, sf_dir)))


def _dictionaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both dictionaries as the log job gets them: written once (S12) and read (S4)."""
    out = []
    for name, dic in (("area", _area_dic(spark, sf_dir)), ("biz", _biz_dic(spark, sf_dir))):
        path = _scratch(spark, f"{name}-dictionary")
        sinks.write_dictionary(dic, path)
        out.append(readers.read_parquet(spark, path))
    return out[0], out[1]


def area_dic_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of a location table (C2b), written (S12) and read back."""
    lng, lat = derive.point(F.col("s_suppkey"), F.col("s_suppkey") + 2)
    located = table(spark, sf_dir, "supplier").select(
        F.lit("P").alias("province"), F.col("s_nationkey").cast("string").alias("city"), F.col("s_name").alias("distract"), lng.alias("lng"), lat.alias("lat")
    )
    path = _scratch(spark, "area-dic")
    sinks.write_dictionary(geo.area_dic_from_locations(located), path)
    return readers.read_parquet(spark, path)


def url_category_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL dimension as prefix,category text in two folders, one of them
    compressed (S11, S2, U2), applied to the pages' URLs."""
    plain, packed = _scratch(spark, "dim-plain"), _scratch(spark, "dim-gz")
    dim = derive.url_dimension(spark, sf_dir).select(F.concat_ws(",", "prefix", "category").alias("value"))
    dim.where(F.col("value").like("%,site%")).write.text(plain)
    dim.where(~F.col("value").like("%,site%")).write.option("compression", "gzip").text(packed)
    pages = table(spark, sf_dir, "pages").select("url")
    return urls.url_categories(pages, readers.read_url_dimension(spark, [plain, packed]), "url")


def _preprocessed(spark: SparkSession, sf_dir: str):
    return preprocess_logs(derive.log_lines(spark, sf_dir), *_dictionaries(spark, sf_dir))


def geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocessed(spark, sf_dir).records.select("commit_time", "cookieid", *geo.GEO_COLUMNS)


def unmatched_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocessed(spark, sf_dir).unmatched


def geo_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed loop (E1): coordinates that no dictionary places, their replies, the
    dictionary with the replies merged in, and the unplaced records looked up again."""
    area, biz = _dictionaries(spark, sf_dir)
    found = preprocess_logs(derive.log_lines(spark, sf_dir), area, biz)
    records = stored(found.records.select("commit_time", "cookieid", "latitude", "longtitude", *geo.GEO_COLUMNS), _scratch(spark, "records"))
    replies = derive.backfill_responses(geo.unmatched_coordinates(records).distinct())
    fresh = stored(geo.geocode_dictionary(replies), _scratch(spark, "replies"))
    path = _scratch(spark, "biz-dictionary-2")
    sinks.write_dictionary(geo.upsert_dictionary(geo.dedupe_dictionary(biz), fresh, 1), path)
    return geo.reenrich(records, area, readers.read_parquet(spark, path)).select("commit_time", "cookieid", *geo.GEO_COLUMNS)


def title_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title keywords of the identified records; the location steps take no part."""
    recs = keywords.add_title_keywords(logs.identity_filter(logs.parse_logs(derive.log_lines(spark, sf_dir))))
    return recs.select("commit_time", "cookieid", F.try_element_at("event", F.lit("keyword")).alias("keyword"))


def title_keywords_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts segmented by a dictionary of fixed syllables (T1); the stop words
    are read from a file."""
    path = _scratch(spark, "stop-words")
    stops = spark.createDataFrame([(w,) for w in keywords.STOP_WORDS], "word string")
    sinks.write_lines(stops, path)
    segmenter = keywords.dictionary_segmenter(SYLLABLES)
    documents = table(spark, sf_dir, "documents").withColumn("_stop_words", keywords.stop_word_array(readers.read_stopwords(spark, path)))
    return documents.select("doc_id", keywords.keywords(F.col("text"), F.col("_stop_words"), segmenter=segmenter).alias("keyword"))


# The dictionary of the lattice's query: so many words of 2 to so many letters.
DICTIONARY_WORDS = 100_000
DICTIONARY_LETTERS = 6


def title_keywords_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts segmented over a lattice (T1): the dictionary is the most frequent short
    words of the texts themselves, so longer words fall into their parts."""
    documents = table(spark, sf_dir, "documents")
    segmenter = lattice.lattice_segmenter(lattice.count_dictionary(documents, "text", 2, DICTIONARY_LETTERS, DICTIONARY_WORDS))
    return documents.select("doc_id", keywords.keywords(F.col("text"), segmenter=segmenter).alias("keyword"))


def traffic_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords are left out: the detail rows do not carry the event map. The page views
    are stored, as their URLs and rows are read apart: lines are parsed once."""
    records = logs.identity_filter(logs.parse_logs(derive.log_lines(spark, sf_dir)))
    enriched = geo.enrich_location(records, *_dictionaries(spark, sf_dir))
    views = stored(urls.page_views(enriched), _scratch(spark, "page-views"))
    return urls.traffic_detail(views, derive.url_dimension(spark, sf_dir))


def traffic_detail_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail rows written by day (S13) and read back from those folders."""
    path = _scratch(spark, "detail")
    sinks.write_parquet(traffic_detail(spark, sf_dir), path, partition_by=["dateStr"])
    return readers.read_parquet(spark, path).withColumn("dateStr", F.col("dateStr").cast("string")).select(*urls.DWD_COLUMNS)


def traffic_detail_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail rows written by day, the days of even number with a wrong category;
    then these days are run again, which replaces them and no others (S13)."""
    path, detail = _scratch(spark, "detail-days"), stored(traffic_detail(spark, sf_dir), _scratch(spark, "detail-rows"))
    even = F.substring("dateStr", 9, 2).cast("int") % 2 == 0
    first = detail.withColumn("ct", F.when(even, F.lit("wrong")).otherwise(F.col("ct")))
    sinks.overwrite_days(first, path, _scratch(spark, "detail-stage"))
    sinks.overwrite_days(detail.where(even), path, _scratch(spark, "detail-stage"))
    return spark.read.schema(detail.schema).parquet(path).select(*urls.DWD_COLUMNS)


def url_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url")
    return urls.url_categories(pages, derive.url_dimension(spark, sf_dir), "url")


# --- geo dictionaries (C2, C3) -----------------------------------------------


def geohash_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    lng, lat = derive.point(F.col("c_custkey"), F.col("c_custkey") * 3)
    return c.select("c_custkey", geohash(lat, lng, 5).alias("geohash5"), geohash(lat, lng, 6).alias("geohash6"))


def area_dump_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_area_dump(derive.area_dump_lines(spark, sf_dir))


def biz_dump_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.parse_biz_dump(derive.biz_dump_lines(spark, sf_dir))


def area_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.area_hierarchy(readers.parse_area_dump(derive.area_dump_lines(spark, sf_dir)))


def area_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_dic(spark, sf_dir)


def biz_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _biz_dic(spark, sf_dir)


def biz_dictionary_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.dedupe_dictionary(_biz_dic(spark, sf_dir))


def geocode_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.geocode_dictionary(derive.geocode_responses(spark, sf_dir))


# --- identities (C7) ---------------------------------------------------------


def _components(spark: SparkSession, sf_dir: str):
    return identity.resolve_identities(derive.identity_rows(spark, sf_dir), ["order_id", "offer_id", "part_id"])


def identity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(spark, sf_dir).labels


def component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(spark, sf_dir).sizes


# Rows up to this date are yesterday's, the others come in two later runs.
FIRST_UNTIL, SECOND_UNTIL = "1994-12-31", "1996-12-31"


def identity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components kept up over three runs (G1-G4): the component that an identifier has
    by its lasting name, and by the smallest member as a run over all rows names it."""
    id_cols = ["order_id", "offer_id", "part_id"]
    rows = derive.identity_rows(spark, sf_dir)
    day = F.to_date("l_shipdate")
    first, second = F.lit(FIRST_UNTIL).cast("date"), F.lit(SECOND_UNTIL).cast("date")
    labels = stored(identity.resolve_identities(rows.where(day <= first), id_cols).labels, _scratch(spark, "labels"))
    for batch in (rows.where((day > first) & (day <= second)), rows.where((day > second) | day.isNull())):
        labels = stored(identity.advance_identities(labels, batch, id_cols).labels, _scratch(spark, "labels"))
    smallest = labels.groupBy("component").agg(F.min("id").alias("smallest"))
    return labels.join(smallest, "component").select("id", "component", "smallest")


def identity_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge log of one later run: names that were given up, and for which ones."""
    id_cols = ["order_id", "offer_id", "part_id"]
    rows = derive.identity_rows(spark, sf_dir)
    early = F.coalesce(F.to_date("l_shipdate") <= F.lit(SECOND_UNTIL).cast("date"), F.lit(False))
    labels = stored(identity.resolve_identities(rows.where(early), id_cols).labels, _scratch(spark, "labels"))
    return identity.advance_identities(labels, rows.where(~early), id_cols).merges


MEMBERS_PER_PAGE = 500


def component_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of each component as bounded lists, in order over the pages."""
    pages = identity.member_pages(_components(spark, sf_dir).labels, MEMBERS_PER_PAGE)
    return pages.select("component", "page", F.size("members").alias("n_members"), F.array_join("members", ",").alias("members"))


# --- text ------------------------------------------------------------------


def stopword_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = wordcount.split_words(docs, "text", r"[^\p{L}\p{N}]+")
    stops = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in keywords.STOP_WORDS])).alias("word"))
    kept = keywords.remove_stopwords(words, stops)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- text file -> typed parquet and back (C9) --------------------------------


_scratch = scratch_path


def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> comma text (S14) -> typed columns (S10) -> parquet (S13) -> read (S4)."""
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 5 == 0, F.concat("c_name", F.lit(', "x"'))).when(key % 5 == 1, F.lit("")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(key % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    text_dir, parquet_dir = _scratch(spark, "text"), _scratch(spark, "parquet")
    sinks.write_lines(c, text_dir)
    typed = readers.read_delimited(spark, text_dir, "id int, name string, segment string")
    sinks.write_parquet(typed, parquet_dir)
    return readers.read_parquet(spark, parquet_dir)


def unmatched_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmatched coordinates written as text (S14) and read back by the
    geocoding step (S2): split ``lng,lat`` and key the point by geohash-6."""
    path = _scratch(spark, "unmatched")
    sinks.write_lines(_preprocessed(spark, sf_dir).unmatched, path)
    back = readers.read_lines(spark, path)
    parts = F.split("value", ",")
    lng, lat = F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")
    return back.select("value", geohash(lat, lng, 6).alias("geohash"))


QUERIES: dict[str, Query] = {
    "activity_zipper": activity_zipper,
    "activity_zipper_daily": activity_zipper_daily,
    "open_interval_close": open_interval_close,
    "activity_intervals_all": activity_intervals_all,
    "activity_intervals_per_user": activity_intervals_per_user,
    "version_upgrades": version_upgrades,
    "activity_intervals_csv": activity_intervals_csv,
    "version_upgrades_csv": version_upgrades_csv,
    "word_count": word_count,
    "word_count_top10": word_count_top10,
    "word_count_first10": word_count_first10,
    "log_flatten": log_flatten,
    "log_rejects": log_rejects,
    "identity_filter": identity_filter,
    "geohash_points": geohash_points,
    "area_dump_parse": area_dump_parse,
    "biz_dump_parse": biz_dump_parse,
    "area_hierarchy": area_hierarchy,
    "area_dictionary": area_dictionary,
    "biz_dictionary": biz_dictionary,
    "biz_dictionary_dedup": biz_dictionary_dedup,
    "geo_enrich": geo_enrich,
    "unmatched_coordinates": unmatched_coordinates,
    "title_keywords": title_keywords,
    "url_category": url_category,
    "traffic_detail": traffic_detail,
    "traffic_detail_by_day": traffic_detail_by_day,
    "traffic_detail_rerun": traffic_detail_rerun,
    "title_keywords_dictionary": title_keywords_dictionary,
    "title_keywords_lattice": title_keywords_lattice,
    "area_dic_file": area_dic_file,
    "url_category_files": url_category_files,
    "geocode_parse": geocode_parse,
    "identity_components": identity_components,
    "component_sizes": component_sizes,
    "component_pages": component_pages,
    "identity_daily": identity_daily,
    "identity_merges": identity_merges,
    "geo_backfill": geo_backfill,
    "stopword_anti": stopword_anti,
    "roundtrip_parquet": roundtrip_parquet,
    "unmatched_roundtrip": unmatched_roundtrip,
}
