"""Date helpers (F2, F3, P9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date that marks an interval still open.
OPEN_END = "9999-12-31"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text (or a date/timestamp) to a date; bad text gives null."""
    return F.try_to_date(_col(c).cast("string"), "yyyy-MM-dd")


def day_diff(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def millis_to_day(ms: Column | str, time_zone: str | None = "UTC") -> Column:
    """Epoch milliseconds to a ``yyyy-MM-dd`` string.

    ``time_zone="UTC"`` (default) is zone-free integer arithmetic; ``None``
    uses the session time zone, like formatting a ``java.util.Date``. Times
    outside the years 1 to 9999 (say, nanoseconds given as milliseconds) have no
    such day and give null.
    """
    millis = _col(ms).cast("long")
    # The first and the last millisecond of the years 1 to 9999.
    millis = F.when(millis.between(-62_135_596_800_000, 253_402_300_799_999), millis)
    if time_zone == "UTC":
        return F.date_from_unix_date(F.floor(millis / F.lit(86_400_000)).cast("int")).cast("string")
    if time_zone is None:
        return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(millis), time_zone), "yyyy-MM-dd")


def ntz_to_millis(ts: Column | str) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` value (zone-free)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, _col(ts).cast("timestamp_ntz"))


def close_open_interval(end: Column | str, as_of: str | _dt.date, sentinel: str = OPEN_END) -> Column:
    """Replace the open-end sentinel by the as-of date (both as dates)."""
    end_col = _col(end)
    as_of_lit = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of))
    return F.when(end_col == F.lit(_dt.date.fromisoformat(sentinel)), as_of_lit).otherwise(end_col)
