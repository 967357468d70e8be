"""Activity intervals: runs of active days, the open-ended interval table, and
the gap histogram (spans in the "gap of 1" bucket, one count per gap between
consecutive intervals of a user).

Scale notes: every window is partitioned by user and sees at most one row per
(user, active run); the runs come from a ``distinct`` on (user, day), which
pre-aggregates map-side, so a user that owns a third of all events still
reaches the window as at most one row per active day. Each interval emits its
span row and its gap row through one ``inline`` (a per-row bag union), so the
interval data is produced once and aggregated with partial aggregation.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.dates import OPEN_END, close_open_interval, parse_day
from tidelog.functions.text import interval_label


def _as_date(df: DataFrame, name: str):
    if isinstance(df.schema[name].dataType, T.DateType):
        return F.col(name)
    return parse_day(name)


def activity_runs(events: DataFrame, user_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """Maximal runs of consecutive active days per user -> (user, start_dt, end_dt)."""
    days = (
        events.where(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
        .select(F.col(user_col).alias(user_col), F.to_date(ts_col).alias("day"))
        .distinct()
    )
    w = Window.partitionBy(user_col).orderBy("day")
    # Days of one run share (day - position in the user's ordered days).
    island = F.date_sub("day", F.row_number().over(w).cast("int"))
    return (
        days.withColumn("_island", island)
        .groupBy(user_col, "_island")
        .agg(F.min("day").alias("start_dt"), F.max("day").alias("end_dt"))
        .drop("_island")
    )


def zipper_table(
    runs: DataFrame, as_of: str | _dt.date, user_col: str = "user_id", sentinel: str = OPEN_END
) -> DataFrame:
    """Interval table in the warehouse's zipper form: a run that reaches the
    day before ``as_of`` is still open and gets the sentinel end date;
    ``first_lg`` is the user's first active day."""
    as_of_d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of)
    last_day = as_of_d - _dt.timedelta(days=1)
    first = F.min("start_dt").over(Window.partitionBy(user_col))
    end = F.when(F.col("end_dt") >= F.lit(last_day), F.lit(_dt.date.fromisoformat(sentinel))).otherwise(
        F.col("end_dt")
    )
    return runs.select(user_col, first.alias("first_lg"), "start_dt", end.alias("end_dt"))


class DayStep(NamedTuple):
    """What one day changes: rows are written to the open part (replacing it), and
    appended to the closed part and the users; the closed part is not read."""

    open: DataFrame  # (user, first_lg, start_dt)
    closed: DataFrame  # (user, first_lg, start_dt, end_dt), those that ended the day before
    new_users: DataFrame  # (user, first_lg)


def open_part(table: DataFrame, user_col: str = "user_id", sentinel: str = OPEN_END) -> DataFrame:
    """The open intervals of a table in the zipper form, without their end."""
    return table.where(F.col("end_dt") == F.lit(_dt.date.fromisoformat(sentinel))).select(user_col, "first_lg", "start_dt")


def closed_part(table: DataFrame, user_col: str = "user_id", sentinel: str = OPEN_END) -> DataFrame:
    return table.where(F.col("end_dt") != F.lit(_dt.date.fromisoformat(sentinel))).select(user_col, "first_lg", "start_dt", "end_dt")


def known_users(table: DataFrame, user_col: str = "user_id") -> DataFrame:
    return table.select(user_col, "first_lg").distinct()


def advance_day(open_rows: DataFrame, users: DataFrame, events: DataFrame, day: str | _dt.date, user_col: str = "user_id", ts_col: str = "ts") -> DayStep:
    """The interval table of yesterday and one ``day`` of events -> today's.

    Open intervals of users who were active go on; the others end the day before;
    users who were active without an open interval open one, keeping the first day
    they are known by. Only open intervals, the day's users and the list of known
    users are read. A day without events closes everything; a day that is run again
    on yesterday's parts gives the same rows.
    """
    day = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(day)
    of_day = events.where(F.col(user_col).isNotNull() & (F.to_date(ts_col) == F.lit(day)))
    active = of_day.select(F.col(user_col).alias("_active")).distinct()
    met = open_rows.join(active, open_rows[user_col] == active["_active"], "full_outer")
    first = users.select(F.col(user_col).alias("_known"), F.col("first_lg").alias("_first"))
    opened = met.where(F.col(user_col).isNull()).select("_active").join(first, F.col("_active") == F.col("_known"), "left")
    fresh = opened.select(F.col("_active").alias(user_col), F.coalesce("_first", F.lit(day)).alias("first_lg"), F.lit(day).alias("start_dt"))
    going_on = met.where(F.col("_active").isNotNull() & F.col(user_col).isNotNull()).select(user_col, "first_lg", "start_dt")
    ended = met.where(F.col("_active").isNull()).select(user_col, "first_lg", "start_dt", F.lit(day - _dt.timedelta(days=1)).alias("end_dt"))
    new = opened.where(F.col("_known").isNull()).select(F.col("_active").alias(user_col), F.lit(day).alias("first_lg"))
    return DayStep(going_on.unionByName(fresh), ended, new)


def assembled(open_rows: DataFrame, closed_rows: DataFrame, user_col: str = "user_id", sentinel: str = OPEN_END) -> DataFrame:
    """Both parts as one table in the zipper form."""
    still = open_rows.withColumn("end_dt", F.lit(_dt.date.fromisoformat(sentinel)))
    return closed_rows.select(user_col, "first_lg", "start_dt", "end_dt").unionByName(still)


def close_intervals(
    intervals: DataFrame,
    as_of: str | _dt.date,
    user_col: str = "user",
    start_col: str = "start_dt",
    end_col: str = "end_dt",
    sentinel: str = OPEN_END,
) -> DataFrame:
    """(user, start_dt, end_dt) as dates, the open end replaced by ``as_of``."""
    return intervals.select(
        F.col(user_col).alias(user_col),
        _as_date(intervals, start_col).alias("start_dt"),
        close_open_interval(_as_date(intervals, end_col), as_of, sentinel).alias("end_dt"),
    )


def interval_histogram(
    intervals: DataFrame,
    as_of: str | _dt.date,
    per_user: bool = False,
    user_col: str = "user",
    start_col: str = "start_dt",
    end_col: str = "end_dt",
    sentinel: str = OPEN_END,
) -> DataFrame:
    """Days per gap bucket, for the whole population or per user.

    Output: ``[user,] interval (label), gap_days int, days bigint``. Intervals
    whose dates do not convert take no part; ``bad_intervals`` returns them.
    """
    iv = close_intervals(intervals, as_of, user_col, start_col, end_col, sentinel)
    iv = iv.where(F.col("start_dt").isNotNull() & F.col("end_dt").isNotNull())
    w = Window.partitionBy(user_col).orderBy("start_dt", "end_dt")
    iv = iv.withColumn("_next_start", F.lead("start_dt").over(w))
    span = F.struct(
        F.lit(1).alias("gap_days"), F.datediff("end_dt", "start_dt").cast("long").alias("days")
    )
    gap = F.struct(
        F.datediff("_next_start", "end_dt").alias("gap_days"),
        F.when(F.col("_next_start").isNotNull(), F.lit(1).cast("long")).alias("days"),
    )
    rows = iv.select(user_col, F.inline(F.array(span, gap))).where(F.col("days").isNotNull())
    keys = [user_col, "gap_days"] if per_user else ["gap_days"]
    out = rows.groupBy(*keys).agg(F.sum("days").alias("days"))
    cols = ([user_col] if per_user else []) + [interval_label("gap_days").alias("interval"), "gap_days", "days"]
    return out.select(*cols)


def bad_intervals(intervals: DataFrame, start_col: str = "start_dt", end_col: str = "end_dt") -> DataFrame:
    """The intervals with a start or end that is no date, as they were given."""
    return intervals.where(_as_date(intervals, start_col).isNull() | _as_date(intervals, end_col).isNull())
