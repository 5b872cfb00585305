"""Streaming jobs: score events as they arrive, keep running statistics.

Every job takes its checkpoint folder, and reads all that has arrived and stops (``availableNow``)
unless a processing interval is given. Restarted on the same checkpoint it goes on where it
stopped: exactly once into files, at least once into a topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayrate.operators.scoring import running_statistics, score_events
from stayrate.streaming.messages import dead_letters, events_of, parse, to_messages


def _trigger(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def predictions_of(messages: DataFrame, predicted_at: str | None = None) -> DataFrame:
    """Predictions of every readable message; works on a batch and on a stream."""
    return score_events(events_of(parse(messages)), predicted_at)


def start_scoring(
    messages: DataFrame,
    sink: str,
    checkpoint: str,
    sink_format: str = "parquet",
    interval: str | None = None,
    predicted_at: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Publish predictions as ``(key, value)`` messages keyed by customer."""
    out = to_messages(predictions_of(messages, predicted_at))
    writer = out.writeStream.format(sink_format).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.options(**(options or {}))
    if sink_format != "kafka":
        writer = writer.option("path", sink)
    return _trigger(writer, interval).start()


def start_dead_letters(messages: DataFrame, sink: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Unreadable messages into a folder of their own."""
    writer = dead_letters(parse(messages)).writeStream.format("parquet").option("path", sink)
    return _trigger(writer.option("checkpointLocation", checkpoint).outputMode("append"), interval).start()


def start_statistics(
    messages: DataFrame, sink: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Running totals after every micro-batch: one row per batch under ``sink``.

    Writing a batch again replaces its own folder, so a retried batch is not counted twice.
    """

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    writer = running_statistics(predictions_of(messages)).writeStream.outputMode("complete")
    return _trigger(writer.option("checkpointLocation", checkpoint).foreachBatch(save), interval).start()


def final_statistics(spark, sink: str) -> DataFrame:
    """The statistics of the last finished batch."""
    rows = spark.read.parquet(sink)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def start_events(events: DataFrame, sink: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Publish event rows of a stream as JSON lines."""
    out = to_messages(events).select("value")
    writer = out.writeStream.format("text").option("path", sink).option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), interval).start()
