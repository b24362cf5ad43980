"""From raw readings to readings that can be averaged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.numbers import (
    TEMPERATURE_LIMIT,
    from_centi,
    passes_temperature_filter,
    to_centi,
)
from fleetgauge.functions.times import parse_event_time

_TELEMETRY_ONLY = ("temperature", "fuel_level", "latitude", "longitude")


def temperature_filter(readings: DataFrame) -> DataFrame:
    """Readings above zero degrees."""
    return readings.where(passes_temperature_filter("temperature"))


def with_event_time(readings: DataFrame) -> DataFrame:
    """Add ``event_time``, null where the timestamp text is none."""
    return readings.withColumn("event_time", parse_event_time("timestamp"))


def normalize(readings: DataFrame) -> DataFrame:
    """Filter, parse and round.

    Gives ``truck_id, temperature_c, event_time, timestamp``, the exact ``temperature_centi`` that the
    aggregates add up, and whatever other columns (``seq``, ``tenant_id``, ...) the readings carry. Apply it
    after duplicates are dropped: a reading at or below zero still claims its key.
    """
    if "event_time" not in readings.columns:
        readings = with_event_time(readings)
    known = {"truck_id", "timestamp", "event_time", *_TELEMETRY_ONLY}
    carried = [c for c in readings.columns if c not in known]
    kept = temperature_filter(readings).where(
        (F.col("temperature") < TEMPERATURE_LIMIT)
        & F.col("truck_id").isNotNull()
        & F.col("event_time").isNotNull()
    )
    centi = to_centi("temperature")
    return kept.select(
        "truck_id",
        from_centi(centi).alias("temperature_c"),
        "event_time",
        "timestamp",
        centi.alias("temperature_centi"),
        *carried,
    )


def rejected_readings(readings: DataFrame) -> DataFrame:
    """The readings that ``normalize`` leaves out, each with the first ``reason`` that applies."""
    if "event_time" not in readings.columns:
        readings = with_event_time(readings)
    t = F.col("temperature")
    reason = (
        F.when(F.col("truck_id").isNull(), "no truck")
        .when(t.isNull(), "no temperature")
        .when(F.isnan(t), "temperature is not a number")
        .when(t <= 0, "temperature not above zero")
        .when(t >= TEMPERATURE_LIMIT, "temperature too large to add up")
        .when(F.col("event_time").isNull(), "timestamp unreadable")
    )
    return readings.withColumn("reason", reason).where(F.col("reason").isNotNull())
