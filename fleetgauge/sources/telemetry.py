"""Telemetry readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions.payloads import decode, encode
from fleetgauge.schemas import TELEMETRY, TELEMETRY_TOPIC
from fleetgauge.sources.logs import arrival_number, read_log


def decode_readings(rows: DataFrame, schema: T.StructType = TELEMETRY) -> DataFrame:
    """Typed readings with ``seq`` (arrival order) and ``arrival`` from log rows.

    ``schema`` is the reader's own: an older one ignores newer fields, a newer one has null for fields an
    older writer did not send. Text that cannot be read leaves every field null.
    """
    decoded = rows.select(
        decode("value", schema).alias("_reading"),
        arrival_number().alias("seq"),
        F.col("timestamp").alias("arrival"),
    )
    return decoded.select(*[F.col(f"_reading.{name}").alias(name) for name in schema.names], "seq", "arrival")


def read_telemetry(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    streaming: bool = False,
    start: str = "earliest",
    schema: T.StructType = TELEMETRY,
    topic: str = TELEMETRY_TOPIC,
    **options: str,
) -> DataFrame:
    return decode_readings(read_log(spark, location, fmt, topic, streaming, start, **options), schema)


def encode_readings(readings: DataFrame, schema: T.StructType = TELEMETRY) -> DataFrame:
    """``(key, value)`` rows of readings, keyed by truck."""
    return readings.select(
        F.col("truck_id").cast("string").alias("key"), encode(*schema.names).alias("value")
    )


def unite_versions(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Typed readings of two schema versions in one table; missing fields are null."""
    return newer.unionByName(older, allowMissingColumns=True)
