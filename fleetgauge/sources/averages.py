"""Window averages on the wire."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetgauge.config import WindowConfig
from fleetgauge.functions.payloads import decode, encode
from fleetgauge.functions.times import parse_event_time
from fleetgauge.operators.windows import window_bounds_iso
from fleetgauge.schemas import AVERAGES_TOPIC, WINDOW_AVERAGE
from fleetgauge.session import make_folder, small_text
from fleetgauge.sources.logs import KAFKA, arrival_number, read_log, write_log
from fleetgauge.streaming.windows import OpenWindows


def encode_averages(averages: DataFrame) -> DataFrame:
    """``(key, value)`` rows: the truck as text, and JSON with ISO bounds."""
    return window_bounds_iso(averages).select(
        F.col("truck_id").cast("string").alias("key"), encode(*WINDOW_AVERAGE.names).alias("value")
    )


def decode_averages(rows: DataFrame) -> DataFrame:
    """Typed averages from ``(key, value)`` rows, with ``seq`` where the rows have log positions."""
    order = [arrival_number().alias("seq")] if "offset" in rows.columns else []
    decoded = rows.select(decode("value", WINDOW_AVERAGE).alias("_average"), *order)
    return decoded.select(
        "_average.truck_id",
        "_average.window_type",
        parse_event_time("_average.window_start").alias("window_start"),
        parse_event_time("_average.window_end").alias("window_end"),
        "_average.average_temperature",
        "_average.reading_count",
        parse_event_time("_average.computed_at").alias("computed_at"),
        *["seq" for _ in order],
    )


def read_averages(
    spark: SparkSession, location: str, fmt: str = "parquet", topic: str = AVERAGES_TOPIC, **options: str
) -> DataFrame:
    """All averages of the log from its start. The file form holds the ``(key, value)`` rows that
    ``write_averages`` leaves."""
    if fmt == "kafka":
        return decode_averages(read_log(spark, location, fmt, topic, **options))
    rows = spark.read.format(fmt).schema("key string, value string").options(**options).load(location)
    return decode_averages(rows)


def write_averages(
    averages: DataFrame, location: str, fmt: str = "parquet", topic: str = AVERAGES_TOPIC
) -> None:
    write_log(encode_averages(averages), location, fmt, topic)


def stream_averages(
    readings: DataFrame,
    location: str,
    checkpoint: str,
    config: WindowConfig,
    fmt: str = "parquet",
    topic: str = AVERAGES_TOPIC,
) -> DataStreamWriter:
    """Writer of closed windows of normalised readings that the duplicate filter has given out; start it with a trigger.

    In files each batch owns one folder, named after the query and the batch, and replaces it, so a batch that is run
    again after a failure leaves one copy. A log gets the batch at least once.
    """
    spark = readings.sparkSession
    windows = OpenWindows(spark, checkpoint, config)
    if fmt != KAFKA:
        make_folder(spark, location)

    def write_batch(given: DataFrame, batch: int) -> None:
        def emit(closed: DataFrame) -> None:
            if fmt == KAFKA:
                write_log(encode_averages(closed), location, fmt, topic)
            else:
                query = json.loads(small_text(spark, f"{checkpoint}/metadata"))["id"]
                encode_averages(closed).write.mode("overwrite").format(fmt).save(f"{location}/batch={query}-{batch}.{fmt}")

        windows.add(given, batch, emit)

    given = readings.select("truck_id", "event_time", "temperature_centi")
    return given.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
