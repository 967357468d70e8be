import json

from pyspark.sql import functions as F

from tidelog.functions import geohash
from tidelog.streaming import preprocess_log_stream, start_parquet_sink, start_traffic_detail

from test_logs_geo import _doc


def test_log_stream_end_to_end(spark, tmp_path):
    landing = tmp_path / "logs"
    landing.mkdir()
    good = _doc(cookie="c9", event={"url": "https://s.example.com/hive/1", "title": "Big sale today"})
    (landing / "part-1.txt").write_text("t --> " + json.dumps(good) + "\nbroken line\n")
    (landing / "part-2.txt").write_text("t --> " + json.dumps(_doc(cookie="c8", lng=10.0, lat=10.0)) + "\n")
    biz = spark.createDataFrame([(13.405, 52.52, "P", "C", "D", "B")],
                                "lng double, lat double, province string, city string, district string, biz string")
    biz_dic = biz.select(geohash("lat", "lng", 6).alias("geohash"), "province", "city", "district", "biz")
    area_dic = spark.createDataFrame([], "geohash string, province string, city string, district string")
    pre = preprocess_log_stream(spark, str(landing), area_dic, biz_dic)
    dim = spark.createDataFrame([("https://s.example.com/hive", "hive")], "prefix string, category string")
    out = tmp_path / "out"
    queries = [
        start_traffic_detail(pre.records, dim, str(out / "dwd"), str(tmp_path / "ck1"), available_now=True),
        start_parquet_sink(pre.unmatched, str(out / "unmatched"), str(tmp_path / "ck2"), available_now=True),
        start_parquet_sink(pre.rejects, str(out / "rejects"), str(tmp_path / "ck3"), available_now=True),
    ]
    for q in queries:
        q.awaitTermination(120)
    dwd = spark.read.parquet(str(out / "dwd"))
    assert sorted((r["cookieid"], r["province"], r["ct"]) for r in dwd.collect()) == [("c8", "", "其他"), ("c9", "P", "hive")]
    assert [r[0] for r in spark.read.parquet(str(out / "unmatched")).collect()] == ["10.0,10.0"]
    assert [r[0] for r in spark.read.parquet(str(out / "rejects")).collect()] == ["broken line"]
    assert dwd.where(F.col("dateStr") == "2019-06-15").count() == 2


def test_restart_keeps_what_the_first_run_wrote(spark, tmp_path):
    landing = tmp_path / "logs"
    landing.mkdir()
    empty = spark.createDataFrame([], "geohash string, province string, city string, district string, biz string")
    dim = spark.createDataFrame([("https://s.example.com", "home")], "prefix string, category string")
    for n in (1, 2):
        (landing / f"part-{n}.txt").write_text("t --> " + json.dumps(_doc(cookie=f"c{n}")) + "\n")
        pre = preprocess_log_stream(spark, str(landing), empty.drop("biz"), empty)
        start_traffic_detail(pre.records, dim, str(tmp_path / "dwd"), str(tmp_path / "ck"), available_now=True).awaitTermination(120)
    assert sorted(r["cookieid"] for r in spark.read.parquet(str(tmp_path / "dwd")).collect()) == ["c1", "c2"]
