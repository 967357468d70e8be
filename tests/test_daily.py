"""Tables that grow day by day: intervals, re-run days, and dump lines as SQL."""

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import last_of_each_key
from tidelog.operators import activity
from tidelog.sources import readers, sinks

from conftest import rows

D = dt.date.fromisoformat


def test_days_in_turn_equal_the_whole(spark):
    rng = random.Random(8)
    days = [D("2024-03-01") + dt.timedelta(days=i) for i in range(6)]
    seen = [(u, dt.datetime.combine(d, dt.time(h))) for u in range(30) for d in days for h in (1, 22) if rng.random() < 0.35 and d.day != 4]
    events = spark.createDataFrame(seen + [(None, seen[0][1]), (7, None)], "user_id int, ts timestamp").cache()
    empty = spark.createDataFrame([], "user_id int, first_lg date, start_dt date, end_dt date")
    open_rows, closed, users = activity.open_part(empty), [activity.closed_part(empty)], [activity.known_users(empty)]
    for day in days:
        step = activity.advance_day(open_rows, reduce(DataFrame.unionByName, users), events, day)
        open_rows, ended, new = (spark.createDataFrame(x.collect(), x.schema) for x in step)
        closed.append(ended)
        users.append(new)
    got = rows(activity.assembled(open_rows, reduce(DataFrame.unionByName, closed)))
    want = rows(activity.zipper_table(activity.activity_runs(events), days[-1] + dt.timedelta(days=1)))
    assert got == want and len(got) > 30


def test_a_day_can_be_run_again(spark, tmp_path):
    path = str(tmp_path / "t")

    def day(d, *values):
        return spark.createDataFrame([(v, d) for v in values], "v int, dateStr string")

    def held():
        return rows(spark.read.schema("v int, dateStr string").parquet(path))

    sinks.overwrite_days(day("2024-01-01", 1, 2).union(day("2024-01-02", 3)), path, str(tmp_path / "s1"))
    sinks.overwrite_days(day("2024-01-02", 4, 5), path, str(tmp_path / "s2"))
    assert held() == [(1, "2024-01-01"), (2, "2024-01-01"), (4, "2024-01-02"), (5, "2024-01-02")]
    sinks.overwrite_days(day("2024-01-02", 4, 5), path, str(tmp_path / "s2"))
    before = held()
    # A failure while a day is staged, or while it is published, leaves the old day.
    broken = day("2024-01-01", 9).select(F.raise_error(F.lit("stop")).cast("int").alias("v"), "dateStr")
    with pytest.raises(Exception, match="stop"):
        sinks.overwrite_days(broken, path, str(tmp_path / "s3"))
    with pytest.raises(Exception, match="stop"):
        sinks.publish_days(broken, path)
    sinks.stage_days(day("2024-01-01", 9), str(tmp_path / "s4"))
    assert held() == before


def test_dump_lines_are_read_as_sql(spark):
    area = [
        "INSERT INTO `areas` VALUES (110101, 'Hafen, Nord', 110100, '', 3, 1, 0.0, 13.5, 52.5);",
        "insert into areas (code, name, parent, x, level, lng, lat) values (1, 'O''Hara (old)', 0, '', 1, 1.0, 2.0), (2,'a\\\\b \\'q\\'',0,NULL,1,'3.0',4.0) ;",
        "-- (1, 2, 3, 4, 5, 6, 7)", "garbage", None, "INSERT INTO t VALUES (1, 'x');", "",
    ]
    df = spark.createDataFrame([(x,) for x in area], "value string")
    assert rows(readers.parse_area_dump(df)) == sorted([
        ("110101", "Hafen, Nord", "110100", "3", "13.5", "52.5"), ("1", "O'Hara (old)", "0", "1", "1.0", "2.0"), ("2", "a\\b 'q'", "0", "1", "3.0", "4.0"),
    ])
    assert {r[0] for r in rows(readers.short_lines(df, 6))} == {None, "", "garbage", area[2], area[5]}
    biz = spark.createDataFrame([("('1', 'P', 'C', 'D', 'Kai, \\'West\\'', '1.5', '2.5');",), ("('2', '', 'C', 'D', '', '1', '2'), ('3', 'P', 'C', 'D', 'b', '1', '2');",)], "value string")
    assert rows(readers.parse_biz_dump(biz), "province", "biz", "lng", "lat") == [("", "", "1", "2"), ("P", "Kai, 'West'", "1.5", "2.5"), ("P", "b", "1", "2")]
    long = spark.createDataFrame([("(" + ", ".join(["'" + "x" * 50000 + "'"] * 7) + ")",)], "value string")
    assert readers.parse_biz_dump(long).count() == 1


def test_last_of_many_keys(spark):
    text = "{" + ", ".join(f'"k{i % 700}": "{i}"' for i in range(2000)) + "}"
    df = spark.createDataFrame([(text,), ("{}",), (None,)], "j string").select(last_of_each_key(F.from_json("j", "map<string,string>")).alias("m"))
    got = [r["m"] for r in df.collect()]
    assert got[0] == {f"k{i % 700}": str(i) for i in range(2000)} and got[1:] == [{}, None]
