"""The access-log pipeline over a directory that keeps receiving files.

The original job processes one day's directory per batch run. Here the same
operators run incrementally: the stateless steps (parse, reject, identity
filter, stream-static geo lookup, keywords)
apply to the streaming DataFrame directly; the traffic-detail step, whose
longest-prefix lookup takes the distinct URLs of its input, runs per
micro-batch through ``foreachBatch``. No streaming state is kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import keywords, urls
from tidelog.plans.pipelines import Preprocessed, preprocess_logs


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def preprocess_log_stream(
    spark: SparkSession,
    path: str,
    area_dic: DataFrame,
    biz_dic: DataFrame,
    stop_words: Iterable[str] | DataFrame | None = keywords.STOP_WORDS,
    max_files_per_trigger: int | None = None,
) -> Preprocessed:
    """Streaming (records, unmatched, rejects) over the files landing in ``path``."""
    return preprocess_logs(read_log_stream(spark, path, max_files_per_trigger), area_dic, biz_dic, stop_words)


def start_traffic_detail(
    records: DataFrame,
    url_dim: DataFrame,
    out_path: str,
    checkpoint_location: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Write each micro-batch's page-view detail rows to parquet under
    ``batch_id=<epoch>/dateStr=<day>``. A micro-batch that is run again after a
    failure overwrites its own folder, so replays never duplicate rows.
    ``checkpoint_location`` numbers the batches and must stay the same over
    restarts: with another one, numbering would begin again over kept folders."""

    def write_batch(batch: DataFrame, epoch: int) -> None:
        detail = urls.traffic_detail(batch, url_dim)
        detail.write.mode("overwrite").partitionBy("dateStr").parquet(f"{out_path.rstrip('/')}/batch_id={epoch}")

    writer = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def start_parquet_sink(
    df: DataFrame, out_path: str, checkpoint_location: str, available_now: bool = False
) -> StreamingQuery:
    """Append a stateless stream (records, unmatched coordinates, rejects) to parquet."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
