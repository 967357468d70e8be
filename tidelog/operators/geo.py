"""Geo dictionaries and location enrichment.

* A8 ``dedupe_dictionary``: one row per geohash (deterministic: smallest tuple).
* J1 ``area_hierarchy``: district -> city -> province by self-joins.
* ``build_area_dic`` / ``build_biz_dic`` / ``area_dic_from_locations``.
* J2/J3 ``enrich_location``: business-district lookup on the 6-character
  geohash, area fallback on the 5-character one when no province was found.
* P14 ``unmatched_coordinates``; E1 ``geocode_dictionary``.

Dictionaries are bounded by geography (cells that hold a district or a
business area). One that the planner's estimate proves small is broadcast and
the facts are not shuffled; beyond that the lookup deals a hot cell's facts
over several tasks (``joins.lookup_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.geo import geohash
from tidelog.operators.joins import MAX_BROADCAST_BYTES, lookup_join

AREA_DIC_COLUMNS = ("geohash", "province", "city", "district")
BIZ_DIC_COLUMNS = ("geohash", "province", "city", "district", "biz")
GEO_COLUMNS = ("province", "city", "district", "biz")


def dedupe_dictionary(dic: DataFrame, key: str = "geohash") -> DataFrame:
    """One row per non-null key: the smallest tuple of the other columns."""
    rest = [c for c in dic.columns if c != key]
    return (
        dic.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in rest])).alias("_v"))
        .select(key, *[F.col("_v")[c].alias(c) for c in rest])
    )


def area_hierarchy(areas: DataFrame) -> DataFrame:
    """(code, name, parent_code, level, lng, lat) -> level-3 rows with their
    level-2 parent and that parent's parent: (province, city, district, lng, lat)."""
    lvl = F.col("level").cast("string")
    a = areas.where(lvl == "3").select(
        F.col("name").alias("district"), F.col("parent_code").alias("_p"), "lng", "lat"
    )
    b = areas.where(lvl == "2").select(
        F.col("code").alias("_p"), F.col("name").alias("city"), F.col("parent_code").alias("_pp")
    )
    c = areas.select(F.col("code").alias("_pp"), F.col("name").alias("province"))
    return a.join(b, "_p").join(c, "_pp").select("province", "city", "district", "lng", "lat")


def build_area_dic(areas: DataFrame, on_bad: str = "drop") -> DataFrame:
    """Area rows -> (geohash5, province, city, district).

    ``on_bad="drop"`` drops rows whose coordinates do not convert;
    ``"zero"`` is the original job's way: a bad longitude zeroes both, a bad
    latitude zeroes only the latitude.
    """
    h = area_hierarchy(areas)
    lng = F.col("lng").cast("string").try_cast("double")
    lat = F.col("lat").cast("string").try_cast("double")
    if on_bad == "zero":
        lng_v = F.coalesce(lng, F.lit(0.0))
        lat_v = F.when(lng.isNull(), F.lit(0.0)).otherwise(F.coalesce(lat, F.lit(0.0)))
    elif on_bad == "drop":
        lng_v, lat_v = lng, lat
    else:
        raise ValueError(f"unknown on_bad {on_bad!r}")
    out = h.select(geohash(lat_v, lng_v, 5).alias("geohash"), "province", "city", "district")
    return out.where(F.col("geohash").isNotNull()) if on_bad == "drop" else out


def area_dic_from_locations(locations: DataFrame, district_col: str = "distract") -> DataFrame:
    """Location table (province, city, distract, lng, lat) -> area dictionary."""
    return locations.select(
        geohash(F.col("lat").cast("double"), F.col("lng").cast("double"), 5).alias("geohash"),
        "province",
        "city",
        F.col(district_col).alias("district"),
    )


def build_biz_dic(districts: DataFrame) -> DataFrame:
    """(province, city, district, biz, lng, lat) -> (geohash6, ...); coordinates
    that do not convert give a null key (dropped later by ``dedupe_dictionary``)."""
    lng = F.col("lng").cast("string").try_cast("double")
    lat = F.col("lat").cast("string").try_cast("double")
    return districts.select(geohash(lat, lng, 6).alias("geohash"), "province", "city", "district", "biz")


def enrich_location(
    records: DataFrame,
    area_dic: DataFrame,
    biz_dic: DataFrame,
    lat: str = "latitude",
    lng: str = "longtitude",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Fill province/city/district/biz (``""`` when unknown), keeping the
    record's column order."""
    biz = dedupe_dictionary(biz_dic.select(*BIZ_DIC_COLUMNS)).select(
        F.col("geohash").alias("_g6"), *[F.col(c).alias("_b_" + c) for c in BIZ_DIC_COLUMNS[1:]]
    )
    area = dedupe_dictionary(area_dic.select(*AREA_DIC_COLUMNS)).select(
        F.col("geohash").alias("_g5"), *[F.col(c).alias("_a_" + c) for c in AREA_DIC_COLUMNS[1:]]
    )
    keyed = records.withColumn("_g6", geohash(lat, lng, 6)).withColumn("_g5", geohash(lat, lng, 5))
    joined = lookup_join(lookup_join(keyed, biz, "_g6", max_bytes), area, "_g5", max_bytes, counted=keyed)
    hit = F.coalesce(F.col("_b_province"), F.lit("")) != ""
    geo = {
        c: F.when(hit, F.coalesce(F.col("_b_" + c), F.lit(""))).otherwise(F.coalesce(F.col("_a_" + c), F.lit("")))
        for c in ("province", "city", "district")
    }
    geo["biz"] = F.coalesce(F.col("_b_biz"), F.lit(""))
    base = [c for c in records.columns if c not in GEO_COLUMNS]
    out = [F.col(c) for c in base] + [geo[c].alias(c) for c in GEO_COLUMNS]
    if all(c in records.columns for c in GEO_COLUMNS):
        out = [geo[c].alias(c) if c in GEO_COLUMNS else F.col(c) for c in records.columns]
    return joined.select(*out)


def upsert_dictionary(current: DataFrame, fresh: DataFrame, version: int) -> DataFrame:
    """A dictionary with the rows of a later version merged in, one row per geohash.

    ``current`` has a ``version`` column, or counts as version 0. Of the rows of a cell
    one that names a province comes before one that does not, then one that names a
    business area, then the later version, then the smallest names; so an empty reply
    never takes a name away, and merging the same replies again changes nothing."""
    names = BIZ_DIC_COLUMNS[1:]
    before = current.select(*BIZ_DIC_COLUMNS, (F.col("version") if "version" in current.columns else F.lit(0)).cast("long").alias("version"))
    both = before.unionByName(fresh.select(*BIZ_DIC_COLUMNS, F.lit(version).cast("long").alias("version"))).where(F.col("geohash").isNotNull())
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in names}
    order = F.struct((filled["province"] == "").alias("no_province"), (filled["biz"] == "").alias("no_biz"), (-F.col("version")).alias("earlier"), *[filled[c].alias(c) for c in names])
    best = both.groupBy("geohash").agg(F.min(order).alias("_v"))
    return best.select("geohash", *[F.col("_v")[c].alias(c) for c in names], (-F.col("_v.earlier")).alias("version"))


def reenrich(records: DataFrame, area_dic: DataFrame, biz_dic: DataFrame, lat: str = "latitude", lng: str = "longtitude", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Enriched records, of which only those without a province are looked up again."""
    unplaced = F.coalesce(F.col("province"), F.lit("")) == ""
    again = enrich_location(records.where(unplaced), area_dic, biz_dic, lat, lng, max_bytes)
    return records.where(~unplaced).unionByName(again)


def unmatched_coordinates(enriched: DataFrame, lat: str = "latitude", lng: str = "longtitude") -> DataFrame:
    """``lng,lat`` text of the records no dictionary placed (input for geocoding)."""
    return enriched.where(F.coalesce(F.col("province"), F.lit("")) == "").select(
        F.concat_ws(",", F.col(lng).cast("string"), F.col(lat).cast("string")).alias("value")
    )


_S = T.StringType()
GEOCODE_SCHEMA = T.StructType(
    [
        T.StructField("status", _S),
        T.StructField(
            "regeocode",
            T.StructType(
                [
                    T.StructField(
                        "addressComponent",
                        T.StructType(
                            [
                                T.StructField("province", _S),
                                T.StructField("city", _S),
                                T.StructField("district", _S),
                                T.StructField(
                                    "businessAreas",
                                    T.ArrayType(
                                        T.StructType([T.StructField("location", _S), T.StructField("name", _S)])
                                    ),
                                ),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)


def _lng_lat(text):
    parts = F.split(text, ",")
    return F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")


def geocode_dictionary(responses: DataFrame, location_col: str = "location", response_col: str = "response") -> DataFrame:
    """Reverse-geocode responses -> business dictionary rows.

    Status ``1``: one row per business area, keyed by the geohash-6 of the
    area's own location; none listed -> one row at the queried point with an
    empty ``biz``. Any other status -> one row at the point with empty names.
    """
    j = F.from_json(F.col(response_col), GEOCODE_SCHEMA)
    ok = j["status"] == "1"
    comp = j["regeocode"]["addressComponent"]
    p_lng, p_lat = _lng_lat(F.col(location_col))
    staged = responses.select(
        p_lng.alias("_plng"),
        p_lat.alias("_plat"),
        F.when(ok, F.coalesce(comp["province"], F.lit(""))).otherwise(F.lit("")).alias("province"),
        F.when(ok, F.coalesce(comp["city"], F.lit(""))).otherwise(F.lit("")).alias("city"),
        F.when(ok, F.coalesce(comp["district"], F.lit(""))).otherwise(F.lit("")).alias("district"),
        F.explode_outer(F.when(ok, comp["businessAreas"])).alias("_area"),
    )
    a_lng, a_lat = _lng_lat(F.col("_area")["location"])
    key = F.when(F.col("_area").isNotNull(), geohash(a_lat, a_lng, 6)).otherwise(geohash("_plat", "_plng", 6))
    return staged.select(
        key.alias("geohash"),
        "province",
        "city",
        "district",
        F.coalesce(F.col("_area")["name"], F.lit("")).alias("biz"),
    )
