"""Sessions over a stream of events: a session is given out once the watermark has passed its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.sessions import CONVERSION, GAP_MINUTES, sessions

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def session_stream(events: DataFrame, delay: str = "1 hour", gap_minutes: int = GAP_MINUTES, conversion: str = CONVERSION) -> DataFrame:
    """``sessions`` of a streaming frame; events more than ``delay`` behind the latest are left out."""
    return sessions(events.withWatermark("ts", delay), gap_minutes, conversion)


def stream_sessions(spark: SparkSession, folder: str, out: str, checkpoint: str, delay: str = "1 hour", files_per_batch: int = 100) -> StreamingQuery:
    """Read the Parquet files of events that are in the folder now, batch by batch, and append the sessions that ended to ``out``."""
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (
        session_stream(events, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
