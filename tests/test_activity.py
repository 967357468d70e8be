from tidelog.operators.activity import activity_runs, bad_intervals, interval_histogram, zipper_table
from tidelog.plans.pipelines import activity_intervals

from conftest import rows

# user, first login, start, end (open end 9999-12-31); the expected days are worked out by hand.
ACTIVE = [
    ("kim", "2021-03-01", "2021-03-01", "2021-03-03"),
    ("kim", "2021-03-01", "2021-03-07", "2021-03-07"),
    ("kim", "2021-03-01", "2021-03-09", "9999-12-31"),
    ("lou", "2021-03-02", "2021-03-02", "2021-03-05"),
    ("lou", "2021-03-02", "2021-03-06", "2021-03-08"),
    ("max", "2021-03-11", "2021-03-11", "9999-12-31"),
    ("ned", "2021-03-04", "2021-03-04", "2021-03-04"),
]


def _intervals(spark):
    return spark.createDataFrame(ACTIVE, "user string, first_lg string, start_dt string, end_dt string")


def test_population_histogram(spark):
    out = activity_intervals(_intervals(spark), "2021-03-12")
    assert rows(out, "gap_days", "days") == [(1, 12), (2, 1), (4, 1)]
    assert rows(out, "interval")[0] == ("隔1天",)


def test_per_user_histogram(spark):
    out = activity_intervals(_intervals(spark), "2021-03-12", per_user=True)
    assert rows(out, "user", "gap_days", "days") == [
        ("kim", 1, 5), ("kim", 2, 1), ("kim", 4, 1), ("lou", 1, 6), ("max", 1, 1), ("ned", 1, 0)
    ]


def test_unsorted_input_is_ordered_by_start(spark):
    shuffled = list(reversed(ACTIVE))
    df = spark.createDataFrame(shuffled, "user string, first_lg string, start_dt string, end_dt string")
    out = interval_histogram(df, "2021-03-12")
    assert rows(out, "gap_days", "days") == [(1, 12), (2, 1), (4, 1)]


def test_bad_dates_are_returned_not_counted(spark):
    bad = [("kim", None, "2021-03-20", "soon"), ("lou", None, None, "2021-03-20")]
    df = spark.createDataFrame(ACTIVE + bad, "user string, first_lg string, start_dt string, end_dt string")
    assert rows(interval_histogram(df, "2021-03-12"), "gap_days", "days") == [(1, 12), (2, 1), (4, 1)]
    assert rows(bad_intervals(df), "user", "end_dt") == [("kim", "soon"), ("lou", "2021-03-20")]


def test_runs_and_zipper_from_events(spark):
    ev = spark.createDataFrame(
        [
            (1, "2024-01-01 10:00:00"), (1, "2024-01-01 11:00:00"), (1, "2024-01-02 09:00:00"),
            (1, "2024-01-05 09:00:00"), (2, "2024-01-09 23:59:59"), (2, "2024-01-10 00:00:01"),
        ],
        "user_id long, ts string",
    ).selectExpr("user_id", "cast(ts as timestamp_ntz) as ts")
    runs = activity_runs(ev)
    got = [(u, str(s), str(e)) for u, s, e in rows(runs, "user_id", "start_dt", "end_dt")]
    assert got == [(1, "2024-01-01", "2024-01-02"), (1, "2024-01-05", "2024-01-05"), (2, "2024-01-09", "2024-01-10")]
    z = zipper_table(runs, "2024-01-11")
    got = [(u, str(f), str(s), str(e)) for u, f, s, e in rows(z, "user_id", "first_lg", "start_dt", "end_dt")]
    assert got[-1] == (2, "2024-01-09", "2024-01-09", "9999-12-31")
    assert got[0] == (1, "2024-01-01", "2024-01-01", "2024-01-02")
