"""The dictionary's back-fill loop, and bounded lists of members."""

from tidelog.operators import geo, identity

from conftest import rows

DIC = "geohash string, province string, city string, district string, biz string"


def test_upsert_precedence(spark):
    old = spark.createDataFrame([("a", "P", "C", "D", "x"), ("b", "", "", "", "kept"), ("c", "", None, "", ""), (None, "P", "", "", "")], DIC)
    fresh = spark.createDataFrame([("a", "Q", "C2", "D2", "y"), ("a", "", "", "", ""), ("b", "", "", "", ""), ("c", "R", "", "", ""), ("d", "", "", "", "")], DIC)
    once = geo.upsert_dictionary(old, fresh, 1)
    want = [("a", "Q", "C2", "D2", "y", 1), ("b", "", "", "", "kept", 0), ("c", "R", "", "", "", 1), ("d", "", "", "", "", 1)]
    assert rows(once) == want
    assert rows(geo.upsert_dictionary(once, fresh, 1)) == want
    later = geo.upsert_dictionary(once, spark.createDataFrame([("c", "S", "", "", "")], DIC), 2)
    assert dict(rows(later, "geohash", "province"))["c"] == "S"


def test_only_unplaced_records_are_looked_up_again(spark):
    records = spark.createDataFrame([(1, 52.5, 13.4, "old", "c", "d", "b"), (2, 52.5, 13.4, "", "", "", ""), (3, 10.0, 10.0, None, "", "", "")], "id int, latitude double, longtitude double, province string, city string, district string, biz string")
    from tidelog.functions.geo import geohash

    cell = records.where("id = 1").select(geohash("latitude", "longtitude", 6).alias("g")).first()["g"]
    biz = spark.createDataFrame([(cell, "new", "c2", "d2", "b2")], DIC)
    got = geo.reenrich(records, biz.limit(0).drop("biz"), biz)
    assert rows(got, "id", "province", "biz") == [(1, "old", "b"), (2, "new", "b2"), (3, "", "")]


def test_pages_of_a_giant_component(spark):
    members = [("big", f"m{i:05d}") for i in range(2345)] + [("one", "x")]
    pages = identity.member_pages(spark.createDataFrame(members, "component string, id string").repartition(5), per_page=100)
    got = {(r["component"], r["page"]): r["members"] for r in pages.collect()}
    assert len(got) == 25 and max(map(len, got.values())) == 100
    assert [m for p in range(24) for m in got["big", p]] == [f"m{i:05d}" for i in range(2345)] and got["one", 0] == ["x"]
