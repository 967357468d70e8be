"""Access-log parsing: ``<anything> --> <json>`` lines to flat typed records.

P1 split, P2/P3 ``from_json`` with an explicit schema (numbers declared as
strings and converted with ``try_cast``, so quoted numbers are accepted),
P4 rejects, P5 identity filter. All of it is one Catalyst projection/filter
over the text scan: no per-row Python, no JVM object decoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.text import any_identifier, last_of_each_key

LOG_SEPARATOR = " --> "

_S = T.StringType()

PHONE_FIELDS = ("imei", "osName", "osVer", "resolution", "androidId", "manufacture", "deviceId")
APP_FIELDS = ("appid", "appVer", "release_ch", "promotion_ch")
LOC_FIELDS = ("areacode", "longtitude", "latitude", "carrier", "netType")

LOG_JSON_SCHEMA = T.StructType(
    [
        T.StructField(
            "u",
            T.StructType(
                [
                    T.StructField("cookieid", _S),
                    T.StructField("account", _S),
                    T.StructField("sessionId", _S),
                    T.StructField("phone", T.StructType([T.StructField(f, _S) for f in PHONE_FIELDS])),
                    T.StructField("app", T.StructType([T.StructField(f, _S) for f in APP_FIELDS])),
                    T.StructField("loc", T.StructType([T.StructField(f, _S) for f in LOC_FIELDS])),
                ]
            ),
        ),
        T.StructField("logType", _S),
        T.StructField("commit_time", _S),
        T.StructField("event", T.MapType(_S, _S)),
    ]
)

IDENTITY_COLUMNS = ("account", "cookieid", "sessionId", "imei", "deviceId", "androidId")


def log_payload(line: Column, sep: str = LOG_SEPARATOR) -> Column:
    """Piece 1 of the line split on ``sep`` (null when there is no separator)."""
    return F.get(F.split(line, "\\Q" + sep + "\\E"), 1)


def _millis(text: Column) -> Column:
    """Integer text as is; a decimal or exponent form (``1.5605568E12``) is
    truncated like a lenient JSON ``getLong`` (exact below 2^53)."""
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))


def _flat_columns(j: Column) -> list[Column]:
    u = j["u"]
    phone, app, loc = u["phone"], u["app"], u["loc"]
    return [
        u["cookieid"].alias("cookieid"),
        u["account"].alias("account"),
        *[phone[f].alias(f) for f in PHONE_FIELDS],
        *[app[f].alias(f) for f in APP_FIELDS],
        loc["areacode"].alias("areacode"),
        loc["longtitude"].try_cast("double").alias("longtitude"),
        loc["latitude"].try_cast("double").alias("latitude"),
        loc["carrier"].alias("carrier"),
        loc["netType"].alias("netType"),
        u["sessionId"].alias("sessionId"),
        j["logType"].alias("logType"),
        _millis(j["commit_time"]).alias("commit_time"),
        last_of_each_key(j["event"]).alias("event"),
    ]


def _complete(j: Column) -> Column:
    """What a record needs: the sub-objects exist and
    the three numbers convert."""
    u = j["u"]
    return (
        u.isNotNull()
        & u["phone"].isNotNull()
        & u["app"].isNotNull()
        & u["loc"].isNotNull()
        & j["event"].isNotNull()
        & u["loc"]["longtitude"].try_cast("double").isNotNull()
        & u["loc"]["latitude"].try_cast("double").isNotNull()
        & _millis(j["commit_time"]).isNotNull()
    )


def _parsed(lines: DataFrame, col: str, sep: str) -> DataFrame:
    payload = log_payload(F.col(col), sep)
    return lines.select(F.col(col).alias("_line"), F.from_json(payload, LOG_JSON_SCHEMA).alias("_j"))


# Keeping or dropping a parsed line is written as ``inline``/``explode`` of a
# zero-or-one element array rather than a ``where``: a filter over the parsed
# struct would be pushed below the projection and ``from_json`` copied into
# every one of its conditions (one JSON parse per condition). A generator is
# not pushed, so each line is parsed exactly once.


def parse_logs(lines: DataFrame, col: str = "value", sep: str = LOG_SEPARATOR) -> DataFrame:
    """Lines -> flat records (22 columns + empty geo columns); bad lines dropped."""
    j = F.col("_j")
    geo = [F.lit("").alias(c) for c in ("province", "city", "district", "biz")]
    record = F.struct(*_flat_columns(j), *geo)
    return _parsed(lines, col, sep).select(F.inline(F.when(_complete(j), F.array(record))))


def rejected_logs(lines: DataFrame, col: str = "value", sep: str = LOG_SEPARATOR) -> DataFrame:
    """The lines ``parse_logs`` drops, with the raw text kept for inspection."""
    bad = ~F.coalesce(_complete(F.col("_j")), F.lit(False))
    return _parsed(lines, col, sep).select(F.explode(F.when(bad, F.array(F.col("_line")))).alias(col))


def tagged_logs(lines: DataFrame, col: str = "value", sep: str = LOG_SEPARATOR) -> DataFrame:
    """Every line as (line, record): the record is null if the line is rejected.
    Stored once, it gives records and rejects from a single parse."""
    j = F.col("_j")
    geo = [F.lit("").alias(c) for c in ("province", "city", "district", "biz")]
    record = F.struct(*_flat_columns(j), *geo)
    return _parsed(lines, col, sep).select(F.col("_line").alias("line"), F.when(_complete(j), record).alias("record"))


def identity_filter(records: DataFrame, cols: tuple[str, ...] = IDENTITY_COLUMNS) -> DataFrame:
    """Keep records with at least one usable identifier; the text ``null``
    counts as empty."""
    return records.where(any_identifier(cols))
