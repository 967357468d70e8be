"""Writers (S12–S14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.joins import proven_small

# Fixed value: how a null is written in delimited text.
NULL_TEXT = "\\N"


def write_dictionary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Dictionary -> parquet: one file if the planner's estimate proves that a
    single task can write it, else as many as there are partitions."""
    (df.coalesce(1) if proven_small(df) else df).write.mode(mode).parquet(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] | None = None
) -> None:
    """Fact table -> parquet, optionally partitioned (e.g. by day) so later
    reads prune whole directories."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_days(df: DataFrame, stage: str, day_col: str = "dateStr") -> DataFrame:
    """First step of a day's run: its rows, written apart and read back. Whatever goes
    wrong until then leaves the table as it was."""
    df.write.mode("overwrite").partitionBy(day_col).parquet(stage)
    # Read with the schema given: a day stays the text or date that it was.
    return df.sparkSession.read.schema(df.schema).parquet(stage).select(*df.columns)


def publish_days(staged: DataFrame, path: str, day_col: str = "dateStr") -> None:
    """Second step: the staged days replace those days of the table, and no others.
    The writer moves finished files into place, so a failed run changes nothing."""
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


def overwrite_days(df: DataFrame, path: str, stage: str, day_col: str = "dateStr") -> None:
    """Write ``df`` into a table partitioned by day so that a day can be run again:
    every day that ``df`` holds is replaced as a whole, all others stay."""
    publish_days(stage_days(df, stage, day_col), path, day_col)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """Text sink: one line per row. A single column is written as it is; several
    go through the CSV writer, which quotes separators and line breaks; a null is
    written as ``NULL_TEXT``, apart from empty text (``readers.read_delimited``
    reads them back)."""
    texts = [F.col(c).cast("string").alias(c) for c in df.columns]
    if len(texts) == 1:
        df.select(texts[0].alias("value")).write.mode(mode).text(path)
    else:
        df.select(*texts).write.mode(mode).option("sep", sep).option("escape", '"').option("nullValue", NULL_TEXT).csv(path)
