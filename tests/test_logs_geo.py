import json

from pyspark.sql import functions as F

from tidelog.functions import geohash
from tidelog.functions.dates import millis_to_day
from tidelog.operators import geo, logs
from tidelog.operators.keywords import add_title_keywords
from tidelog.plans.pipelines import build_area_dic, build_biz_dic, preprocess_logs
from tidelog.sources.readers import parse_area_dump, parse_biz_dump, short_lines

from conftest import rows


def _doc(cookie="c1", account="acc", lng=13.405, lat=52.52, event=None, **over):
    d = {
        "u": {
            "cookieid": cookie, "account": account, "sessionId": "s1",
            "phone": {"imei": "i1", "osName": "android", "osVer": "9", "resolution": "1080*1920",
                      "androidId": "a1", "manufacture": "m", "deviceId": "d1"},
            "app": {"appid": "app", "appVer": "2.0", "release_ch": "r", "promotion_ch": "p"},
            "loc": {"areacode": "1", "longtitude": lng, "latitude": lat, "carrier": "cm", "netType": "wifi"},
        },
        "logType": "pg_view",
        "commit_time": 1560556800000,
        "event": event if event is not None else {"url": "http://x.example.com/a", "title": "Hello big world"},
    }
    d.update(over)
    return d


def _lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def test_parse_accepts_quoted_numbers_and_stringifies_event(spark):
    doc = _doc(lng="116.5", event={"n": 87, "flag": True, "obj": {"a": 1}, "none": None})
    out = logs.parse_logs(_lines(spark, ["2019 --> " + json.dumps(doc)])).first()
    assert out["longtitude"] == 116.5 and out["latitude"] == 52.52
    assert out["commit_time"] == 1560556800000
    assert out["event"]["n"] == "87" and out["event"]["flag"] == "true"
    assert json.loads(out["event"]["obj"]) == {"a": 1} and out["event"]["none"] is None
    assert (out["province"], out["biz"]) == ("", "")


def test_repeated_event_keys_are_not_fatal(spark):
    text = json.dumps(_doc()).replace('"event": {', '"event": {"url": "first", "title": "gone", ')
    out = add_title_keywords(logs.parse_logs(_lines(spark, ["t --> " + text]))).first()["event"]
    assert out == {"url": "http://x.example.com/a", "title": "Hello big world", "keyword": "Hello big world"}


def test_far_commit_time_is_not_fatal(spark):
    out = logs.parse_logs(_lines(spark, ["t --> " + json.dumps(_doc(commit_time=t)) for t in (1560556800000000000, 0)]))
    assert sorted(str(r[0]) for r in out.select(millis_to_day("commit_time")).collect()) == ["1970-01-01", "None"]


def test_one_parse_for_three_outputs(spark, tmp_path):
    area_dic, biz_dic = _dics(spark)
    lines = _lines(spark, ["t --> " + json.dumps(_doc(lng=10.0, lat=10.0)), "broken"])
    pre = preprocess_logs(lines, area_dic, biz_dic, store=str(tmp_path / "parsed"))
    assert pre.records.count() == 1 and [r[0] for r in pre.rejects.collect()] == ["broken"]
    assert [r[0] for r in pre.unmatched.collect()] == ["10.0,10.0"]
    assert "from_json" not in pre.records._jdf.queryExecution().executedPlan().toString()


def test_commit_time_forms(spark):
    docs = [_doc(commit_time=1.5605568e12), _doc(commit_time="1560556800000"), _doc(commit_time="soon")]
    out = logs.parse_logs(_lines(spark, ["t --> " + json.dumps(d) for d in docs]))
    assert sorted(r["commit_time"] for r in out.collect()) == [1560556800000, 1560556800000]


def test_bad_lines_are_rejected_not_fatal(spark):
    good = "t --> " + json.dumps(_doc())
    no_loc = _doc()
    del no_loc["u"]["loc"]
    bad_lat = _doc(lat="north")
    lines = [good, good[: len(good) // 2], "no separator " + json.dumps(_doc()),
             "t --> " + json.dumps(no_loc), "t --> " + json.dumps(bad_lat), "t --> [1,2]"]
    df = _lines(spark, lines)
    assert logs.parse_logs(df).count() == 1
    assert sorted(r[0] for r in logs.rejected_logs(df).collect()) == sorted(lines[1:])


def test_identity_filter_treats_null_text_as_empty(spark):
    anon = _doc(cookie="null", account=None)
    anon["u"]["sessionId"] = " "
    anon["u"]["phone"].update(imei="null", androidId="\t", deviceId="")
    half = _doc(cookie="nullnull", account=None)
    half["u"]["sessionId"] = None
    half["u"]["phone"].update(imei=None, androidId=None, deviceId=None)
    keep = _doc(cookie="null", account="x")
    df = logs.parse_logs(_lines(spark, ["t --> " + json.dumps(d) for d in (anon, half, keep)]))
    assert [r["account"] for r in logs.identity_filter(df).collect()] == ["x"]


def _dics(spark):
    biz = spark.createDataFrame(
        [
            ("13.405", "52.52", "Berlin", "Berlin", "Mitte", "Markt"),
            ("13.405", "52.52", "Berlin", "Berlin", "Mitte", "A-first"),  # duplicate cell
            ("2.2945", "48.8584", "", "Paris", "Quai", "Tour"),                    # hit without province
            ("bad", "48.0", "x", "x", "x", "x"),                                   # null key
        ],
        "lng string, lat string, province string, city string, district string, biz string",
    )
    area = spark.createDataFrame(
        [("2.2945", "48.8584", "Paris", "Paris", "Quai"), ("-0.1276", "51.5072", "England", "London", "Soho")],
        "lng string, lat string, province string, city string, district string",
    )
    biz_dic = geo.build_biz_dic(biz)
    area_dic = area.select(geohash(F.col("lat").cast("double"), F.col("lng").cast("double"), 5).alias("geohash"),
                           "province", "city", "district")
    return area_dic, biz_dic


def test_enrichment_rules(spark):
    area_dic, biz_dic = _dics(spark)
    docs = [
        _doc(cookie="biz", lng=13.405, lat=52.52),
        _doc(cookie="fallback", lng=2.2945, lat=48.8584),
        _doc(cookie="area", lng=-0.1276, lat=51.5072),
        _doc(cookie="none", lng=10.0, lat=10.0),
    ]
    pre = preprocess_logs(_lines(spark, ["t --> " + json.dumps(d) for d in docs]), area_dic, biz_dic)
    got = {r["cookieid"]: (r["province"], r["city"], r["district"], r["biz"]) for r in pre.records.collect()}
    assert got["biz"] == ("Berlin", "Berlin", "Mitte", "A-first")       # smallest tuple of the duplicates
    assert got["fallback"] == ("Paris", "Paris", "Quai", "Tour")      # empty province -> area, biz kept
    assert got["area"] == ("England", "London", "Soho", "")
    assert got["none"] == ("", "", "", "")
    assert [r[0] for r in pre.unmatched.collect()] == ["10.0,10.0"]
    kw = {r["cookieid"]: r["event"]["keyword"] for r in pre.records.collect()}
    assert kw["biz"] == "Hello big world"


def test_dictionary_dedupe_is_deterministic(spark):
    _, biz_dic = _dics(spark)
    d = geo.dedupe_dictionary(biz_dic)
    assert d.count() == 2
    assert d.where(F.col("geohash").isNull()).count() == 0


def test_area_dump_hierarchy(spark):
    def line(code, name, parent, level, lng, lat):
        return f"INSERT INTO `areas` VALUES ({code}, '{name}', {parent}, '', {level}, 9, 0.5, 0.5, 0.5, 0.5, {lng}, {lat});"

    lines = [
        line(510000, "Nord", 0, 1, 13.0, 52.0),
        line(510100, "Stadt", 510000, 2, 13.1, 52.1),
        line(510101, "Hafen", 510100, 3, 13.2, 52.2),
        line(510102, "Heide", 510100, 3, "oops", 52.3),
        "garbage",
    ]
    df = _lines(spark, lines)
    parsed = rows(parse_area_dump(df), "code", "name", "parent_code", "level", "lng", "lat")
    assert parsed[2] == ("510101", "Hafen", "510100", "3", "13.2", "52.2")
    assert len(parsed) == 4
    dic = rows(build_area_dic(df), "province", "city", "district")
    assert dic == [("Nord", "Stadt", "Hafen")]
    assert rows(short_lines(df, 6)) == [("garbage",)]
    zero = rows(build_area_dic(df, on_bad="zero"), "geohash", "district")
    assert ("s0000", "Heide") in zero


def test_biz_dump_parse(spark):
    df = _lines(spark, ["('7', 'Berlin', 'Berlin', 'Mitte', 'Markt', '13.405', '52.52');"])
    assert rows(parse_biz_dump(df)) == [("Berlin", "Berlin", "Mitte", "Markt", "13.405", "52.52")]
    assert rows(build_biz_dic(df), "geohash") == [("u33dc0",)]


def test_geocode_dictionary(spark):
    ok = {"status": "1", "regeocode": {"addressComponent": {"province": "P", "city": "C", "district": "D",
          "businessAreas": [{"location": "13.405,52.52", "name": "Markt"}, {"location": "0,0", "name": "Z"}]}}}
    empty = {"status": "1", "regeocode": {"addressComponent": {"province": "P", "city": "C", "district": "D",
             "businessAreas": []}}}
    fail = {"status": "0"}
    df = spark.createDataFrame(
        [("13.405,52.52", json.dumps(ok)), ("13.405,52.52", json.dumps(empty)), ("0,0", json.dumps(fail))],
        "location string, response string",
    )
    assert rows(geo.geocode_dictionary(df)) == [
        ("s00000", "", "", "", ""), ("s00000", "P", "C", "D", "Z"),
        ("u33dc0", "P", "C", "D", ""), ("u33dc0", "P", "C", "D", "Markt"),
    ]
