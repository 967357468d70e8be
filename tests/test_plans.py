"""Plan-shape checks: the properties that matter at scale, read from explain."""

import gzip
import json
import re

from tidelog.functions import geohash
from tidelog.operators import activity, geo, logs
from tidelog.session import stored
from tidelog.sources import readers

from test_logs_geo import _doc


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_log_line_is_parsed_once(spark):
    lines = spark.createDataFrame([("t --> " + json.dumps(_doc()),)], "value string")
    for df in (logs.parse_logs(lines), logs.rejected_logs(lines), logs.identity_filter(logs.parse_logs(lines))):
        assert _plan(df).count("from_json(") == 1


def test_enrichment_broadcasts_dictionaries(spark, tmp_path):
    lines = spark.createDataFrame([("t --> " + json.dumps(_doc()),)], "value string")
    dic = spark.createDataFrame([(52.5, 13.4, "P", "C", "D", "B")],
                                "lat double, lng double, province string, city string, district string, biz string")
    biz = dic.select(geohash("lat", "lng", 6).alias("geohash"), "province", "city", "district", "biz")
    area = dic.select(geohash("lat", "lng", 5).alias("geohash"), "province", "city", "district")
    # From files the planner knows the sizes.
    biz, area = stored(biz, str(tmp_path / "biz")), stored(area, str(tmp_path / "area"))
    plan = _plan(geo.enrich_location(logs.parse_logs(lines), area, biz))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan


def test_activity_histogram_shuffles_twice_before_final_aggregate(spark):
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "user_id long, ts string").selectExpr(
        "user_id", "cast(ts as timestamp_ntz) as ts")
    z = activity.zipper_table(activity.activity_runs(ev), "2024-01-02")
    plan = _plan(activity.interval_histogram(z, "2024-01-02", per_user=True, user_col="user_id"))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(keys) == 2, keys


def test_read_lines_multi_path_and_gzip(spark, tmp_path):
    plain = tmp_path / "a.txt"
    plain.write_text("x\ny\n")
    gz = tmp_path / "b.txt.gz"
    with gzip.open(gz, "wt") as f:
        f.write("z\n")
    df = readers.read_lines(spark, [str(plain), str(gz)], partitions=3)
    assert sorted(r[0] for r in df.collect()) == ["x", "y", "z"]
    assert df.rdd.getNumPartitions() == 3


def test_oversized_dictionary_falls_back_to_shuffle_join(spark):
    docs = [_doc(cookie=f"c{i}", lng=13.4 + i * 0.01, lat=52.5) for i in range(5)]
    lines = spark.createDataFrame([("t --> " + json.dumps(d),) for d in docs], "value string")
    dic = spark.createDataFrame([(52.5, 13.4 + i * 0.01, "P", "C", f"D{i}", "B") for i in range(0, 5, 2)],
                                "lat double, lng double, province string, city string, district string, biz string")
    biz = dic.select(geohash("lat", "lng", 6).alias("geohash"), "province", "city", "district", "biz")
    area = dic.select(geohash("lat", "lng", 5).alias("geohash"), "province", "city", "district")
    recs = logs.parse_logs(lines)
    small = geo.enrich_location(recs, area, biz, max_bytes=1 << 70)
    big = geo.enrich_location(recs, area, biz, max_bytes=0)
    assert "BroadcastHashJoin" in _plan(small)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(big)
        got_big = sorted(tuple(r) for r in big.select("cookieid", "district").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert got_big == sorted(tuple(r) for r in small.select("cookieid", "district").collect())
