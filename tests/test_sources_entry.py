import os

import __spark_entry__ as entry_mod
from tidelog.sources import readers, sinks

from conftest import rows


def test_csv_keeps_leading_blanks_and_strings(spark, tmp_path):
    p = tmp_path / "app.csv"
    p.write_text("app_name,app_date,app_ver\n   maps,2020-01-05,1.0\n")
    df = readers.read_csv(spark, str(p))
    assert df.dtypes == [("app_name", "string"), ("app_date", "string"), ("app_ver", "string")]
    assert df.first()["app_name"] == "   maps"


def test_stopwords_read_as_text(spark, tmp_path):
    p = tmp_path / "stop.txt"
    p.write_text("的\n,\nis\n")
    assert rows(readers.read_stopwords(spark, str(p))) == [(",",), ("is",), ("的",)]


def test_text_to_parquet_roundtrip(spark, tmp_path):
    src = tmp_path / "person.txt"
    src.write_text("1,ana,x\n2,bo,y\nq,bad,y\n")
    out = str(tmp_path / "par")
    sinks.write_parquet(readers.read_delimited(spark, str(src), "id int, name string, gender string"), out)
    back = readers.read_parquet(spark, out)
    assert back.dtypes[0] == ("id", "int")
    assert rows(back) == [(None, "bad", "y"), (1, "ana", "x"), (2, "bo", "y")]
    lines_out = str(tmp_path / "lines")
    sinks.write_lines(back.where("id is not null"), lines_out)
    assert sorted(r[0] for r in spark.read.text(lines_out).collect()) == ["1,ana,x", "2,bo,y"]
    dic_out = str(tmp_path / "dic")
    sinks.write_dictionary(back, dic_out)
    assert len([f for f in os.listdir(dic_out) if f.endswith(".parquet")]) == 1


def test_url_dimension_reader(spark, tmp_path):
    p = tmp_path / "dim.txt"
    p.write_text("https://s.example.com,首页\nhttps://s.example.com/a,A专栏\n")
    assert rows(readers.read_url_dimension(spark, str(p))) == [
        ("https://s.example.com", "首页"), ("https://s.example.com/a", "A专栏")]


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["interval", "gap_days", "days"]
    assert df.count() > 0
    qs, oracles = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 25


def test_area_dic_from_location_table(spark):
    from tidelog.plans.pipelines import build_area_dic_from_locations

    locations = spark.createDataFrame(
        [("P", "C", "D", 2.2945, 48.8584), ("Q", "R", "S", 0.0, 0.0)],
        "province string, city string, distract string, lng double, lat double",
    )
    assert rows(build_area_dic_from_locations(locations)) == [("s0000", "Q", "R", "S"), ("u09tu", "P", "C", "D")]


def test_text_to_parquet_pipeline(spark, tmp_path):
    from tidelog.plans.pipelines import text_to_parquet

    src = tmp_path / "person.txt"
    src.write_text("1,ana,x\n2,bo,y\n")
    back = text_to_parquet(spark, str(src), "id int, name string, gender string", str(tmp_path / "out"))
    assert rows(back) == [(1, "ana", "x"), (2, "bo", "y")]


def test_several_columns_come_back_as_they_were(spark, tmp_path):
    given = [(1, None, "SEG"), (2, "a,b", "SEG"), (3, "", 'say "x", y'), (4, "two\nlines", None), (None, None, None)]
    df = spark.createDataFrame(given, "id int, name string, segment string")
    sinks.write_lines(df, str(tmp_path / "t"))
    back = readers.read_delimited(spark, str(tmp_path / "t"), "id int, name string, segment string")
    assert rows(back) == rows(df)


def test_no_cached_rows_stay(spark):
    """Size checks and component rounds keep nothing in storage."""
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    queries = entry_mod.queries()
    for name in ("identity_components", "traffic_detail", "geo_enrich", "stopword_anti", "url_category"):
        queries[name](spark, entry_mod.SMOKE_DIR).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_changed_dimension_is_seen(spark, tmp_path):
    from tidelog.operators import urls

    facts = spark.createDataFrame([("http://a.example.com/x",)], "url string")
    path = str(tmp_path / "dim")

    def category():
        return urls.categorize(facts, spark.read.parquet(path)).first()["ct"]

    for prefix, name in (("http://a.", "old"), ("http://a.example", "new")):
        spark.createDataFrame([(prefix, name)], "prefix string, category string").write.mode("append").parquet(path)
        assert category() == name


def test_traffic_detail_parses_lines_once(spark):
    """Page views are stored: what is left to run reads neither lines nor dictionaries."""
    detail = entry_mod.queries()["traffic_detail"](spark, entry_mod.SMOKE_DIR)
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "from_json" not in plan.lower()
    assert detail.count() > 0
