"""Record schemas and the names shared by readers, operators and writers."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the three keyed logs and their partition count.
TELEMETRY_TOPIC = "truck-telemetry"
AVERAGES_TOPIC = "truck-averages"
CHANGELOG_TOPIC = "truck-state-changelog"
TOPIC_PARTITIONS = 20

# A reading redelivered by an at-least-once source has the same key.
READING_KEY = ("truck_id", "timestamp")

TELEMETRY_V1 = T.StructType([
    T.StructField("truck_id", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

TELEMETRY = T.StructType([
    *TELEMETRY_V1.fields,
    T.StructField("fuel_level", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# Rows as the Kafka source delivers them, with key and value already cast to text.
LOG_ROW = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# A window average on the wire: bounds and computation time are ISO-8601 text.
WINDOW_AVERAGE = T.StructType([
    T.StructField("truck_id", T.LongType()),
    T.StructField("window_type", T.StringType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("average_temperature", T.DoubleType()),
    T.StructField("reading_count", T.LongType()),
    T.StructField("computed_at", T.StringType()),
])

STATE_VALUE = T.StructType([
    T.StructField("sum", T.DoubleType()),
    T.StructField("count", T.LongType()),
])

FLEET_CSV = T.StructType([
    T.StructField("truck_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("fuel", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])
FLEET_CSV_TIME = "dd-MM-yyyy HH:mm"
