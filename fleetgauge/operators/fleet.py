"""The live picture of the fleet: latest values, roster, anomalies, recent readings, positions.

Latest values of a table are found by aggregates of numbers over the arrival order, which combine inside each partition
by hashing, and the newest reading of each truck is then fetched by its arrival number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.times import iso_utc
from fleetgauge.operators.windows import HOPPING, TUMBLING

# Alert thresholds in degrees and the sizes of the reports.
ALERT_ABOVE = 42.0
CRITICAL_ABOVE = 45.0
ALERT_TYPE = "High Temperature Alert"
ANOMALIES_KEPT = 50
ANOMALIES_SHOWN = 15
READINGS_SHOWN = 20
ROSTER_PAGE = 200


def fleet_latest(accepted: DataFrame, order: str = "seq") -> DataFrame:
    """Per truck the last temperature (null included) and timestamp, and the last known fuel and position.

    An aggregate that held the timestamp text would sort all readings by truck. Therefore it holds numbers alone, and
    the text comes from a join on the arrival number, for which both sides read the same columns and so share the
    exchange of whatever made the readings. A stream can't be joined with its own aggregate and keeps the text.
    """

    def last_known(name: str):
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)

    if not accepted.isStreaming:
        known = ("fuel_level", "latitude", "longitude")
        newest = accepted.groupBy("truck_id").agg(
            F.max(order).alias(order), *[last_known(c).alias(f"_{c}") for c in known]
        )
        rows = accepted.select("truck_id", order, "temperature", "timestamp", *known)
        return rows.join(newest, ["truck_id", order]).select(
            "truck_id",
            F.col("temperature").alias("last_temperature"),
            F.col("timestamp").alias("last_timestamp"),
            *[F.coalesce(c, f"_{c}").alias(c) for c in known],
            F.lit("active").alias("status"),
        )
    return accepted.groupBy("truck_id").agg(
        F.max_by("temperature", order).alias("last_temperature"),
        F.max_by("timestamp", order).alias("last_timestamp"),
        last_known("fuel_level"),
        last_known("latitude"),
        last_known("longitude"),
        F.lit("active").alias("status"),
    )


def latest_averages(averages: DataFrame, order: str = "seq") -> DataFrame:
    """Per truck the last tumbling and hopping average and the readings counted.

    ``reading_count`` adds up both kinds of window, as the dashboard shows it; ``tumbling_count`` has each
    reading once. ``first_average`` and ``first_computed_at`` stand in for a truck without readings.
    """

    def of_kind(kind: str):
        return F.when(F.col("window_type") == kind, F.col(order))

    counted = F.coalesce("reading_count", F.lit(0).cast("bigint"))
    return averages.where(F.col("truck_id").isNotNull()).groupBy("truck_id").agg(
        F.max_by("average_temperature", of_kind(TUMBLING)).alias("tumbling_avg"),
        F.max_by("average_temperature", of_kind(HOPPING)).alias("hopping_avg"),
        F.sum(counted).alias("reading_count"),
        F.sum(F.when(F.col("window_type") == TUMBLING, counted).otherwise(0)).alias("tumbling_count"),
        F.min_by("average_temperature", order).alias("first_average"),
        F.min_by("computed_at", order).alias("first_computed_at"),
    )


def fleet_roster(accepted: DataFrame, averages: DataFrame, order: str = "seq") -> DataFrame:
    """Latest readings merged with latest averages, one row per truck known from either.

    A truck known only from averages shows its first one as last temperature. A last reading whose
    temperature is null stays null.
    """
    latest = fleet_latest(accepted, order).withColumn("_has_reading", F.lit(True))
    merged = latest.join(latest_averages(averages, order), "truck_id", "full_outer")
    zero = F.lit(0).cast("bigint")
    return merged.select(
        "truck_id",
        F.when(F.col("_has_reading"), F.col("last_temperature"))
        .otherwise(F.col("first_average"))
        .alias("last_temperature"),
        F.when(F.col("_has_reading"), F.col("last_timestamp"))
        .otherwise(iso_utc("first_computed_at"))
        .alias("last_timestamp"),
        "fuel_level",
        "latitude",
        "longitude",
        "tumbling_avg",
        "hopping_avg",
        F.coalesce("reading_count", zero).alias("reading_count"),
        F.coalesce("tumbling_count", zero).alias("tumbling_count"),
        F.lit("active").alias("status"),
    )


def roster_page(roster: DataFrame, rows: int = ROSTER_PAGE) -> DataFrame:
    return roster.orderBy("truck_id").limit(rows)


def anomalies(accepted: DataFrame) -> DataFrame:
    """Accepted readings above the alert threshold; neither null nor NaN is one."""
    t = F.col("temperature")
    hot = accepted.where((t > ALERT_ABOVE) & ~F.isnan(t))
    return hot.select(
        "truck_id",
        "temperature",
        "timestamp",
        F.lit(ALERT_TYPE).alias("type"),
        F.when(t > CRITICAL_ABOVE, "critical").otherwise("warning").alias("severity"),
        *[c for c in ("seq", "arrival") if c in accepted.columns],
    )


def newest_first(readings: DataFrame, order: str) -> list[Column]:
    """Sort order of recent lists. Numbers from a log follow arrival within one partition only, so that the time of
    arrival comes before them where readings carry it."""
    return [F.col(c).desc() for c in ("arrival", order) if c in readings.columns]


def recent_anomalies(accepted: DataFrame, rows: int = ANOMALIES_SHOWN, order: str = "seq") -> DataFrame:
    """The newest anomalies, newest first, as many as asked for."""
    return anomalies(accepted).orderBy(*newest_first(accepted, order)).limit(rows)


def recent_readings(accepted: DataFrame, rows: int = READINGS_SHOWN, order: str = "seq") -> DataFrame:
    """The newest accepted readings, newest first."""
    return accepted.orderBy(*newest_first(accepted, order)).limit(rows)


def fleet_positions(roster: DataFrame) -> DataFrame:
    """Roster with where its coordinates come from and whether the last temperature is an anomaly.
    A truck without both coordinates gets null ones and the source ``simulated``."""
    has_gps = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    t = F.col("last_temperature")
    return roster.withColumns({
        "map_latitude": F.when(has_gps, F.col("latitude")),
        "map_longitude": F.when(has_gps, F.col("longitude")),
        "gps_source": F.when(has_gps, "kafka").otherwise("simulated"),
        "is_anomalous": F.coalesce((t > ALERT_ABOVE) & ~F.isnan(t), F.lit(False)),
    })
