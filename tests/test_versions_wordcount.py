import datetime as dt

from tidelog.operators.versions import version_upgrades
from tidelog.operators.wordcount import word_count

from conftest import rows

PAD = " " * 3
# App names with leading blanks, a repeated row, an older version installed later.
APPS = [
    (PAD + "maps", "2020-01-05", "1.0"), (PAD + "maps", "2020-01-05", "1.0"), (PAD + "maps", "2020-02-01", "1.2"),
    (PAD + "maps", "2020-03-09", "1.1"), (PAD + "chat", "2020-01-02", "4.0"), (PAD + "chat", "2020-05-01", "4.0"),
    (PAD + "game", "2020-01-01", "7"), (PAD + "game", "2020-01-01", "7"),
]


def test_upgrades_fixture(spark):
    df = spark.createDataFrame(APPS, "app_name string, app_date string, app_ver string")
    out = version_upgrades(df)
    assert rows(out, "app_name", "app_date", "app_ver", "next_ver") == [
        (PAD + "chat", "2020-01-02", "4.0", "4.0"),
        (PAD + "maps", "2020-01-05", "1.0", "1.1"),
        (PAD + "maps", "2020-03-09", "1.1", "1.2"),
    ]
    trimmed = version_upgrades(df, trim=True)
    assert {r[0] for r in rows(trimmed, "app_name")} == {"chat", "maps"}


def test_numeric_version_order(spark):
    df = spark.createDataFrame(
        [("x", dt.date(2020, 1, 1), "1.9"), ("x", dt.date(2020, 2, 1), "1.10"), ("x", dt.date(2020, 3, 1), "1.2")],
        "app_name string, app_date date, app_ver string",
    )
    lex = rows(version_upgrades(df), "app_ver", "next_ver")
    num = rows(version_upgrades(df, version_order="numeric"), "app_ver", "next_ver")
    assert lex == [("1.10", "1.2"), ("1.2", "1.9")]
    assert num == [("1.2", "1.9"), ("1.9", "1.10")]


def test_word_count_literals(spark):
    df = spark.createDataFrame([("red,blue,red",), ("green,blue",), (",red",)], "value string")
    assert rows(word_count(df)) == [("blue", 2), ("green", 1), ("red", 3)]
    top = word_count(df, top=2, order="count").collect()
    assert [tuple(r) for r in top] == [("red", 3), ("blue", 2)]
    first = word_count(df, top=3).collect()
    assert [r[0] for r in first] == ["blue", "green", "red"]
