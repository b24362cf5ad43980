"""Event time without readings.

A stream's clock is the newest event time it has seen, so that the last windows of a finite input, or of a fleet that
has fallen silent, stay open. Marker rows advance it: files with an ``event_time`` and nothing else, read as a stream
of their own and united with the readings before the watermark. No output ever holds one.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.config import WindowConfig
from fleetgauge.functions.times import instant

MARKER = "event_time timestamp"
# Watermarks are whole milliseconds, rounded down.
_TICK = timedelta(milliseconds=1)


def _markers(rows: DataFrame, at: datetime | None) -> DataFrame:
    return rows.select((instant(at) if at else F.lit(None).cast("timestamp")).alias("event_time"))


def open_clock(spark: SparkSession, location: str) -> None:
    """Make the folder of the markers, which has to be there when a stream starts. Markers in it stay."""
    _markers(spark.range(0), None).write.mode("append").parquet(location)


def clock_stream(spark: SparkSession, location: str) -> DataFrame:
    return spark.readStream.schema(MARKER).parquet(location)


def advance(spark: SparkSession, location: str, to: datetime) -> None:
    """Leave a marker. Older and repeated ones do nothing: the clock never goes back."""
    _markers(spark.range(1, numPartitions=1), to).write.mode("append").parquet(location)


def watermark_of(query: StreamingQuery, config: WindowConfig) -> datetime | None:
    """The latest watermark that the query has reported, or that its newest event time makes in the next batch; None if it
    has seen no event time."""
    def time(text: str) -> datetime:
        return datetime.fromisoformat(text.replace("Z", "+00:00"))

    seen = [p.eventTime for p in query.recentProgress if p.eventTime]
    found = [time(e["watermark"]) for e in seen if e.get("watermark")]
    found += [time(e["max"]) - timedelta(seconds=config.expires) for e in seen if e.get("max")]
    newest = max(found, default=None)
    return newest if newest and newest.timestamp() > 0 else None


def closing_time(watermark: datetime, config: WindowConfig) -> datetime:
    """A marker's time at which no window is open of readings that a stream with this watermark has seen: the newest
    reading is ``expires`` ahead of the watermark, its last window ends at most a size later, and the watermark that
    the marker makes is ``expires`` behind it."""
    return watermark + timedelta(seconds=2 * config.expires + config.size) + 2 * _TICK
