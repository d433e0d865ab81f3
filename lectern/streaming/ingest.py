"""Streams: incremental cutting of new books, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.sections import cut_documents, section_rows


def ingested(docs: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Cuts a stream of ``(stem, text)`` into sections and appends them, each batch in its own folder, which a repeated batch overwrites: exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        section_rows(cut_documents(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time: str, group: str, value: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by tumbling window; on a stream, rows later than ``late`` are left out and finished windows are emitted once."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, size).alias("w"), group)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), group, "n", "total")
    )


def sessions(events: DataFrame, time: str, group: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Sessions of a group's events with less than ``gap`` between them."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), group).agg(F.count("*").alias("n")).select(group, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")
