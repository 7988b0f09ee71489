"""Dashboard values over a stream of prediction-log rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnflow.operators.monitoring import measures, summed, with_dashboard

#: Process what is there, then stop. ``{"processingTime": "1 minute"}`` keeps a query running.
ALL_THERE_IS = {"availableNow": True}


def stream_dashboard(
    log: DataFrame, seconds: int = 300, slide: int = 60, watermark: str = "10 minutes", distinct: bool = False
) -> DataFrame:
    """The batch dashboard's columns per closed window, for append mode.

    The log is counted per slide first, and the slides are summed to sliding windows, so the
    state holds one row per open slide and window. Every row counts; with ``distinct``, for sources that deliver rows
    again, a request id that comes again within the watermark counts once, so ids have to name requests, not customers.
    Rows later than the watermark are dropped.
    """
    if seconds % slide:
        raise ValueError("the window length has to be a multiple of the slide")
    rows = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    if distinct:
        rows = rows.dropDuplicatesWithinWatermark(["request_id"])
    slides = rows.groupBy(F.window("ts", f"{slide} seconds").alias("slide")).agg(
        *[c.alias(n) for n, c in measures().items()]
    )
    windows = (
        slides.groupBy(F.window(F.window_time("slide"), f"{seconds} seconds", f"{slide} seconds").alias("w"))
        .agg(*summed())
        .withColumn("window_start", F.col("w.start"))
    )
    return with_dashboard(windows, seconds)


def start_to_table(stream: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Appends the stream to a Parquet table, for as long as the trigger says."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_THERE_IS))
        .start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> str:
    """Processes everything that is there, appends to a Parquet table, and stops."""
    start_to_table(stream, path, checkpoint).awaitTermination()
    return path
