"""The three streaming queries: averages, running state, and the published snapshot.

Each has its own checkpoint, which is its consumer position and its state. Readings come from
``read_telemetry(..., streaming=True)`` or any stream with the telemetry columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.config import DEFAULT_WINDOWS, WindowConfig, seconds
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.fleet import fleet_latest
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.state import truck_totals
from fleetgauge.operators.windows import window_averages
from fleetgauge.session import setting
from fleetgauge.sources.averages import stream_averages
from fleetgauge.sources.changelog import stream_changelog
from fleetgauge.streaming.clock import advance, clock_stream, closing_time, open_clock, watermark_of

# State and snapshot have no lateness of their own; duplicates are remembered for this long.
STATE_DELAY = "1 day"


def readings_of(
    readings: DataFrame, config: WindowConfig = DEFAULT_WINDOWS, clock: DataFrame | None = None
) -> DataFrame:
    """Readings to deduplicated and normalised ones. On a stream each is given out when the watermark, ``expires``
    seconds behind the newest event time of readings and markers, has passed it."""
    timed = with_event_time(readings)
    return normalize(dedup_readings(timed, delay=seconds(config.expires), clock=clock))


def averages_of(
    readings: DataFrame, config: WindowConfig = DEFAULT_WINDOWS, clock: DataFrame | None = None
) -> DataFrame:
    """Readings to window averages. On a stream each window is emitted once, when the watermark has passed its end;
    its sums lie in the state store until then (``start_averages`` keeps them in files)."""
    return window_averages(readings_of(readings, config, clock), config)


def totals_of(readings: DataFrame, delay: str = STATE_DELAY) -> DataFrame:
    """Readings to running totals per truck; on a stream, in update mode."""
    return truck_totals(normalize(dedup_readings(with_event_time(readings), delay=delay, at_once=True)))


def latest_of(readings: DataFrame, delay: str = STATE_DELAY) -> DataFrame:
    """Readings to the latest values per truck; on a stream, in update mode. A stream needs an event time to
    forget old keys by, so there readings whose timestamp cannot be parsed are dropped."""
    first = dedup_readings(with_event_time(readings), delay=delay, at_once=True)
    return fleet_latest(first.where(F.col("temperature").isNull() | ~(F.col("temperature") <= 0)))


def run(writer, name: str | None = None, every: str | None = None) -> StreamingQuery:
    """Start a writer: until stopped with a trigger interval, else over what is available now."""
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_averages(
    readings: DataFrame,
    location: str,
    checkpoint: str,
    config: WindowConfig = DEFAULT_WINDOWS,
    fmt: str = "parquet",
    every: str | None = None,
    clock: DataFrame | None = None,
) -> StreamingQuery:
    """Write each window once, when the watermark has passed its end."""
    return run(stream_averages(readings_of(readings, config, clock), location, checkpoint, config, fmt), every=every)


def finish_averages(
    readings: DataFrame,
    location: str,
    checkpoint: str,
    clock: str,
    config: WindowConfig = DEFAULT_WINDOWS,
    fmt: str = "parquet",
    until: datetime | None = None,
) -> None:
    """Run over all readings that are there, then advance event time by a marker in the folder ``clock`` and run on from
    the same checkpoint, so that the last windows come out too. Readings of closed windows that arrive later are late.

    A query that is to be finished some day has to read the markers from its first run on (``start_averages(clock=...)``),
    as a checkpoint knows the sources that its query began with.

    The marker's time follows from the watermark of the first run. A run that has read nothing, as after a failure
    between the two, has none; then ``until`` says how far to advance. Calling this again is harmless.
    """
    spark = readings.sparkSession
    open_clock(spark, clock)
    markers = clock_stream(spark, clock)
    # The next run's first batch closes what a batch without data would close at the end of this one.
    with setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):
        query = start_averages(readings, location, checkpoint, config, fmt, clock=markers)
    query.awaitTermination()
    watermark = watermark_of(query, config)
    if until is None and watermark is not None:
        until = closing_time(watermark, config)
    if until is not None:
        advance(spark, clock, until)
        start_averages(readings, location, checkpoint, config, fmt, clock=markers).awaitTermination()


def start_state(
    readings: DataFrame,
    location: str,
    checkpoint: str,
    delay: str = STATE_DELAY,
    fmt: str = "parquet",
    every: str | None = None,
) -> StreamingQuery:
    return run(stream_changelog(totals_of(readings, delay), location, checkpoint, fmt), every=every)


def start_snapshot(
    readings: DataFrame,
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    delay: str = STATE_DELAY,
    every: str | None = None,
) -> StreamingQuery:
    """Hand the trucks that changed in each micro-batch to ``publish(rows, batch)``."""
    writer = (
        latest_of(readings, delay)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    return run(writer, every=every)


def dropped_as_late(progress: dict) -> int:
    """Rows behind the watermark in one progress report, summed over the stateful operators."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in progress.get("stateOperators", []))


def dropped_as_duplicate(progress: dict) -> int:
    """Rows the duplicate filter dropped in one progress report."""
    return sum(
        int(op.get("customMetrics", {}).get("numDroppedDuplicateRows", 0))
        for op in progress.get("stateOperators", [])
    )


def _offsets(value: str | dict | None) -> dict:
    """Offsets of a report: a text in a live query's report, a dictionary once that report has been parsed."""
    return json.loads(value) if isinstance(value, str) else value or {}


def offsets_of(spark: SparkSession, progress: dict) -> DataFrame:
    """``(topic, partition, high, committed)`` from a progress report of a Kafka query, for ``consumer_lag``.
    One row per partition of the topics read, so its size does not follow the data."""
    rows = []
    for source in progress.get("sources", []):
        latest, read = (_offsets(source.get(k)) for k in ("latestOffset", "endOffset"))
        for topic, partitions in latest.items():
            for partition, high in partitions.items():
                committed = read.get(topic, {}).get(partition)
                rows.append((topic, int(partition), int(high), None if committed is None else int(committed)))
    return spark.createDataFrame(rows, "topic string, partition int, high bigint, committed bigint")
