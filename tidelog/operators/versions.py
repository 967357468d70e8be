"""Version upgrades: each distinct install row paired with the next version of
the same app (A1 de-duplicate, W1 ``lead``, P7 not-null filter).

After the ``distinct`` an app has at most one row per (date, version), so the
window partition of even the busiest app stays bounded by its release history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def version_sort_key(ver: str):
    """Numeric ordering key: ``"1.10.2"`` -> [1, 10, 2] (non-numeric parts null)."""
    return F.transform(F.split(F.col(ver), r"\."), lambda p: p.try_cast("int"))


def version_upgrades(
    installs: DataFrame,
    app: str = "app_name",
    date: str = "app_date",
    ver: str = "app_ver",
    version_order: str = "lexical",
    trim: bool = False,
) -> DataFrame:
    """-> (app_name, app_date, app_ver, next_ver), last version of each app dropped.

    ``version_order="lexical"`` compares versions as strings (the original job's
    behaviour); ``"numeric"`` compares dot-separated parts as integers. Ties on
    the version are broken by date so the pairing is deterministic.
    """
    app_col = F.trim(F.col(app)) if trim else F.col(app)
    base = installs.select(app_col.alias("app_name"), F.col(date).alias("app_date"), F.col(ver).alias("app_ver"))
    dedup = base.distinct()
    if version_order == "lexical":
        order = [F.col("app_ver"), F.col("app_date")]
    elif version_order == "numeric":
        order = [version_sort_key("app_ver"), F.col("app_ver"), F.col("app_date")]
    else:
        raise ValueError(f"unknown version_order {version_order!r}")
    w = Window.partitionBy("app_name").orderBy(*order)
    return dedup.withColumn("next_ver", F.lead("app_ver").over(w)).where(F.col("next_ver").isNotNull())
