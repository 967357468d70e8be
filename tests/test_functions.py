import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import (
    GEOHASH_ALPHABET,
    any_identifier,
    geohash,
    interval_label,
    is_blank,
    map_put,
    millis_to_day,
    non_blank_array,
)


def bisect_geohash(lat, lng, p):
    lo, hi, bits, even = [-90.0, -180.0], [90.0, 180.0], [], True
    for _ in range(5 * p):
        i, v = (1, lng) if even else (0, lat)
        mid = (lo[i] + hi[i]) / 2
        if v >= mid:
            bits.append(1)
            lo[i] = mid
        else:
            bits.append(0)
            hi[i] = mid
        even = not even
    return "".join(GEOHASH_ALPHABET[int("".join(map(str, bits[k : k + 5])), 2)] for k in range(0, 5 * p, 5))


def test_geohash_goldens(spark):
    df = spark.createDataFrame(
        [(52.52, 13.405), (48.8584, 2.2945), (0.0, 0.0)], "lat double, lng double"
    )
    got = [tuple(r) for r in df.select(geohash("lat", "lng", 6), geohash("lat", "lng", 5)).collect()]
    assert got[0][0] == "u33dc0"
    assert got[1][1] == "u09tu"
    assert got[2][1] == "s0000"


def test_geohash_null_and_out_of_range(spark):
    df = spark.createDataFrame([(None, 1.0), (95.0, 1.0), (1.0, -181.0), (90.0, 180.0)], "lat double, lng double")
    got = [r[0] for r in df.select(geohash("lat", "lng", 6)).collect()]
    assert got == [None, None, None, "zzzzzz"]


def test_geohash_matches_bisection(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(2000)]
    pts += [(-90.0, -180.0), (0.0, 0.0), (45.0, 90.0), (-45.0, -90.0)]
    df = spark.createDataFrame(pts, "lat double, lng double")
    for p in (1, 5, 6, 8):
        got = df.select("lat", "lng", geohash("lat", "lng", p).alias("g")).collect()
        bad = [(r.lat, r.lng) for r in got if r.g != bisect_geohash(r.lat, r.lng, p)]
        assert not bad, (p, bad[:3])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180)), min_size=1, max_size=60))
def test_geohash_property(spark, pts):
    df = spark.createDataFrame(pts, "lat double, lng double")
    for r in df.select("lat", "lng", geohash("lat", "lng", 6).alias("g")).collect():
        assert r.g == bisect_geohash(r.lat, r.lng, 6), (r.lat, r.lng)


def test_blank_and_identifiers(spark):
    df = spark.createDataFrame(
        [(None, " ", "null"), ("\t", "", None), ("nullx", None, None), ("a", None, None)], "a string, b string, c string"
    )
    got = [r[0] for r in df.select(any_identifier(["a", "b", "c"])).collect()]
    assert got == [False, False, True, True]
    blanks = [r[0] for r in df.select(is_blank("a")).collect()]
    assert blanks == [True, True, False, False]
    arrs = [r[0] for r in df.select(non_blank_array(["a", "b", "c"])).collect()]
    assert arrs == [["null"], [], ["nullx"], ["a"]]


def test_map_put_overwrites(spark):
    df = spark.createDataFrame([({"title": "x", "keyword": "old"},)], "m map<string,string>")
    got = df.select(map_put("m", "keyword", F.lit("new")).alias("m")).first()["m"]
    assert got == {"title": "x", "keyword": "new"}


def test_labels_and_days(spark):
    df = spark.createDataFrame([(3, 1560556800000)], "n int, ms long")
    r = df.select(interval_label("n").alias("l"), millis_to_day("ms").alias("d")).first()
    assert r["l"] == "隔3天"
    assert r["d"] == "2019-06-15"
    assert dt.date.fromisoformat(r["d"])


def test_day_helpers_ignore_session_time_zone(spark):
    from tidelog.functions.dates import ntz_to_millis

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = spark.createDataFrame([("2019-06-15 23:59:59.999",)], "s string").select(
                ntz_to_millis(F.col("s").cast("timestamp_ntz")).alias("ms"),
                millis_to_day(F.lit(1560643199999)).alias("d"),
            ).first()
            assert (r["ms"], r["d"]) == (1560643199999, "2019-06-15"), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
