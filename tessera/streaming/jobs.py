"""File-source streams feeding the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.text import sentiment_counts
from tessera.plans.trips import clean_trips, trips_from_events
from tessera.session import checkpoint_dir


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source as a stream (new files are picked up as they land)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def incremental_clean(events_stream: DataFrame, sink_path: str, checkpoint: str | None = None,
                      trigger_once: bool = True):
    """P1 incrementally: each new batch of raw events is mapped, cleaned and
    appended to a parquet sink; progress is kept in the checkpoint folder so a
    restarted job resumes exactly where it stopped."""
    spark = events_stream.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/clean_trips"
    cleaned = clean_trips(trips_from_events(events_stream))
    writer = (cleaned.writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", ckpt).outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def streaming_sentiment_counts(text_stream: DataFrame, text: str = "text") -> DataFrame:
    """P10 over a stream: running totals per class (complete-mode aggregate,
    state = one row per class)."""
    return sentiment_counts(text_stream, text)
